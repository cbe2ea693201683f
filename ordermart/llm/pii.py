"""Personal data: base patterns, and further spans chosen by gradient-boosted trees.

Base spans are the leftmost non-overlapping matches of four patterns (e-mail, IP address, card
number, phone number) that pass their check; matches that fail are dropped and not tried again, so
a number glued to another one is lost.  The method adds such spans: generators of high recall
propose overlapping candidates with looser or narrower patterns; boosted trees score each from its
format (length, digits, groups, checksum) and context (characters and words beside it); candidates
whose score reaches their kind's calibrated threshold become spans if no base span covers them.

The trees learn without hand labels: candidates inside a verified base span are positive, candidates
that fail their kind's hard check (checksum, range, glued to letters or digits) negative, all others
unlabelled.  They are fitted on about ``TRAIN_ROWS`` labelled candidates at most, in equal parts by kind
and label; the thresholds on all of another quarter.

Everything runs in the JVM (SQL functions and Spark's own GBTClassifier; the fitted trees become one
SQL expression).  The texts are read once and nothing is shuffled but aggregates; a document's
matches stay in arrays on its row.  The patterns use possessive repeats and look-behinds so that a
text of any length, of one character class too, is searched in linear time.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import spare_name, stored

#: Kinds in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone")

#: The base patterns, as searches in linear time.  A match starts where its character run starts, or
#: where the match before it ended (\G); repeats that a match never gives back are possessive.
#: Card numbers of under 12 digits are left out at once, as no part of them can pass.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Candidate patterns.
CANDIDATES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z]{2,24})++",
    "ip": r"(?<![0-9])[0-9]{1,3}(\.|\[\.\]|\(\.\)| \. | ?\[dot\] ?| ?\(dot\) ?)[0-9]{1,3}(?:\1[0-9]{1,3}){2}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "phone": r"\(?(?<![0-9])(?:[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{10}"
             r"|(?:\+|00)[1-9][0-9]{0,2}(?:[ .-][0-9]{2,4}){2,5}|0[1-9](?:[ .-][0-9]{2}){4}|0[0-9]{2,4}\)?[ /-][0-9]{5,8}"
             r"|[6-9][0-9]{2}(?:[ .-][0-9]{3}){2}|[6-9][0-9]{2}(?:[ .-][0-9]{2}){3})(?![0-9])",
}

#: What must occur in a text for a pattern to be tried.
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9](?:\.[0-9]| \.| ?[\[(])", "card": r"[0-9][ -]?[0-9]", "phone": r"[0-9]"}

TRAIN_ROWS = 20_000       # labelled candidates that the trees learn from, about, at most
CONTEXT = 24              # characters before a candidate whose words count
TREES = 12
DEPTH = 3
PRECISION = 0.95          # of calibration candidates at or over a kind's threshold
_RUN = 256                # lengths added up in one go

#: Words whose presence before a candidate is a feature, by kind.
CUES = {"email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|pay|credit",
        "phone": "phone|tel|call|fax|mobile|whatsapp"}

FEATURES = (["is_" + k for k in KINDS] + ["length", "digits", "groups", "brackets", "checksum", "wide_part",
            "letter_before", "digit_before", "letter_after", "digit_after", "quote_before", "distinct_digits", "sentence_end", "plain_digits"]
            + ["cue_" + k for k in KINDS])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does the last digit of a string of digits check the others?"""
    backwards = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(F.filter(backwards, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int"))
                    .when(d.cast("int") < 5, d.cast("int") * 2).otherwise(d.cast("int") * 2 - 9)),
        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(12, 19) & F.when(F.length(digits) <= 19, luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _found(df: DataFrame, text: str, patterns: dict[str, str], out: str) -> DataFrame:
    """``df`` with a column per kind: array of (start, value) of all matches.

    A match begins after the lengths of the gaps and matches before it.  They are added up in runs of
    ``_RUN``, each step in a column of its own (a lambda evaluates what it refers to once per
    element), so that the work grows in proportion to the matches.
    """
    def name(what, k):
        return f"{out}_{what}_{k}"

    def step(what, of):
        return df.withColumns({name(what, k): F.when(F.size(name("hits", k)) > 0, of(k)) for k in KINDS})

    def lengths(k):
        return F.transform(name("hits", k), lambda h, i: F.length(F.element_at(F.col(name("gaps", k)), i + 1)) + F.length(h))

    def run_sums(k):
        both = F.col(name("both", k))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(both) - 1) / _RUN).cast("int")),
                           lambda r: F.aggregate(F.slice(both, r * _RUN + 1, F.lit(_RUN)), F.lit(0), lambda a, x: a + x))

    def run_starts(k):
        return F.aggregate(name("sums", k), F.array(F.lit(0)), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))

    def pairs(k):
        both, runs, gaps = (F.col(name(w, k)) for w in ("both", "runs", "gaps"))

        def pair(h, i):
            r = F.floor(i / _RUN).cast("int")
            inside = F.aggregate(F.slice(both, r * _RUN + 1, i % _RUN), F.lit(0), lambda a, x: a + x)
            return F.struct((F.element_at(runs, r + 1) + inside + F.length(F.element_at(gaps, i + 1))).alias("start"),
                            h.alias("value"))

        none = F.array().cast("array<struct<start:int,value:string>>")
        return F.coalesce(F.when(F.size(name("hits", k)) > 0, F.transform(name("hits", k), pair)), none)

    df = df.withColumns({name("hits", k): F.when(F.col(text).rlike(NEEDS[k]), F.regexp_extract_all(
        text, F.lit(patterns[k]), F.lit(0))) for k in KINDS})
    df = step("gaps", lambda k: F.split(text, patterns[k], -1))
    df = step("both", lengths)
    df = step("sums", run_sums)
    df = step("runs", run_starts)
    df = df.withColumns({f"{out}_{k}": pairs(k) for k in KINDS})
    return df.drop(*[name(w, k) for w in ("hits", "gaps", "both", "sums", "runs") for k in KINDS])


def _flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def _features(kind: str, c: Column, text: Column) -> Column:
    """(start, end, kind, label, features) of a candidate; label -1 is unknown."""
    start, value = c["start"], c["value"]
    bare = F.regexp_replace(value, r"^(?:\+|00)", "") if kind == "phone" else value
    digits = _digits(bare)
    begin = F.greatest(start - CONTEXT, F.lit(0))
    context = F.lower(F.substring(text, begin + 1, start - begin))
    before = F.when(start > 0, F.substring(text, start, F.lit(1))).otherwise("")
    after = F.substring(text, start + F.length(value) + 1, F.lit(1))
    checked = valid(kind, value) if kind == "card" else F.lit(False)
    wide = ~valid("ip", F.regexp_replace(value, "[^0-9]+", ".")) if kind == "ip" else F.lit(False)
    sentence = value.rlike(r"[^ ]\. ") if kind == "email" else F.lit(False)      # 'we met @ noon. Then'
    plain = value.rlike("^[0-9]+$") if kind == "phone" else F.lit(False)
    numbered = before.rlike(r"[=#:/_.,$-]")
    glued = before.rlike(r"[\p{L}0-9]") | after.rlike(r"[\p{L}0-9]")
    failed = {"card": ~checked, "ip": wide, "phone": glued | (plain & numbered), "email": value.rlike(r"[^ ]\. ?[A-Z][a-z]") & sentence}[kind]
    numbers = ([1.0 if k == kind else 0.0 for k in KINDS]
               + [F.length(bare), F.length(digits), F.size(F.split(bare, "[^0-9A-Za-z]+")),
                  _flag(value.contains("(") | value.contains("[")), _flag(checked), _flag(wide),
                  _flag(before.rlike(r"\p{L}")), _flag(before.rlike("[0-9]")), _flag(after.rlike(r"\p{L}")),
                  _flag(after.rlike("[0-9]")), _flag(before.rlike("[\"'=]")),
                  F.size(F.array_distinct(F.split(digits, ""))), _flag(sentence), _flag(plain)]
               + [_flag(context.rlike(CUES[k])) for k in KINDS])
    return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), F.lit(KINDS.index(kind)).alias("kind"),
                    failed.alias("failed"),
                    F.array(*[x.cast("double") if isinstance(x, Column) else F.lit(x) for x in numbers]).alias("f"))


def scan(docs: DataFrame, text: str, base: str, cands: str) -> DataFrame:
    """``docs`` with its base spans (start, end, kind) and its candidates that no base span covers or
    that are labelled (start, end, kind, label, f, and h, a hash of text and place).  A null text has none."""
    mine = spare_name(docs.columns, "pii_text")
    mark = spare_name(docs.columns, "pii_mark")
    df = docs.withColumn(mine, F.coalesce(F.col(text).cast("string"), F.lit(""))).withColumn(mark, F.xxhash64(mine))
    taken = set(df.columns)
    prefix_base, prefix_cand = spare_name([c.split("_")[0] for c in taken], "b"), spare_name([c.split("_")[0] for c in taken], "c")
    df = _found(df, mine, BASE, prefix_base)
    df = _found(df, mine, CANDIDATES, prefix_cand)

    def spans(k):
        return F.transform(F.filter(f"{prefix_base}_{k}", lambda m: valid(k, m["value"])), lambda m: F.struct(
            m["start"].alias("start"), (m["start"] + F.length(m["value"])).alias("end"),
            F.lit(KINDS.index(k)).alias("kind")))

    def proposals(k):
        return F.transform(f"{prefix_cand}_{k}", lambda c: _features(k, c, F.col(mine)))

    df = df.withColumn(base, F.array_sort(F.concat(*[spans(k) for k in KINDS])))
    seen = F.concat(*[proposals(k) for k in KINDS])
    df = df.withColumn(cands, seen)
    return df.withColumn(cands, F.transform(cands, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"),
        F.when(F.exists(F.col(base), lambda b: (b["kind"] == c["kind"]) & (b["start"] <= c["start"]) & (b["end"] >= c["end"])), 1)
        .when(c["failed"], 0).otherwise(-1).alias("label"), c["f"].alias("f"),
        F.xxhash64(F.col(mark), c["start"]).alias("h")))).select(*docs.columns, base, cands)


def _tree_sql(node, f: Column) -> Column:
    """A fitted regression tree as nested CASE expressions."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(F.get(f, F.lit(int(split.featureIndex()))) <= float(split.threshold()), _tree_sql(node.leftChild(), f)
                  ).otherwise(_tree_sql(node.rightChild(), f))


class Scorer:
    """Boosted trees and a threshold per kind; without enough labels it selects nothing."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[int, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, f: Column) -> Column:
        margin = sum((_tree_sql(t, f) * w for t, w in zip(self.trees, self.weights)), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2.0))

    def selects(self, c: Column) -> Column:
        if not self.trees:
            return F.lit(False)
        least = F.element_at(F.array(*[F.lit(self.thresholds.get(i, 2.0)) for i in range(len(KINDS))]), c["kind"] + 1)
        return self.score(c["f"]) >= least


def _shares(sizes: dict[tuple, int], most: int) -> dict[tuple, float]:
    """The share to take of each group so that about ``most`` are taken in all: small groups whole, the
    others the same number each."""
    left, out = most, {}
    for i, (group, n) in enumerate(sorted(sizes.items(), key=lambda g: (g[1], g[0]))):
        take = min(n, left / (len(sizes) - i))
        left -= take
        out[group] = take / n
    return out


def fit(found: DataFrame, cands: str, train_rows: int = TRAIN_ROWS, precision: float = PRECISION) -> Scorer:
    """Trees from three quarters of the labelled candidates (by hash of text and place), thresholds from
    all others: per kind the lowest score at which the share of positives stays at least ``precision``.
    Copies of a text count once in both.

    Of the three quarters about ``train_rows`` are taken, by the hash, so the same rows however the table is
    partitioned; each kind and label has an equal part, or all it has, so a frequent kind displaces no other.
    A kind whose calibration fold has no negative candidate gets 0.5; one without a positive, none.
    """
    labelled = (found.select(F.explode(cands).alias("c")).where("c.label >= 0")
                .select(F.col("c.label").cast("double").alias("label"), F.col("c.kind").alias("kind"), F.col("c.f").alias("f"),
                        F.col("c.h").alias("h")))
    learn, test = labelled.where(F.pmod("h", F.lit(4)) != 0), labelled.where(F.pmod("h", F.lit(4)) == 0)
    sizes = {(r["kind"], r["label"]): r["n"]
             for r in learn.groupBy("kind", "label").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if len({label for _, label in sizes}) < 2:
        return Scorer([], [], {})
    place = F.col("h") / F.lit(2.0 ** 64) + 0.5
    taken = F.lit(False)
    for (kind, label), share in _shares(sizes, train_rows).items():
        taken = taken | ((F.col("kind") == kind) & (F.col("label") == label) & (place <= share))
    sample = stored(learn.where(taken).groupBy("kind", "label", "h").agg(F.min("f").alias("f"))
                    .repartition(1).sortWithinPartitions("h", "kind", "label"), "pii-sample")
    if sample.select("label").distinct().count() < 2:
        return Scorer([], [], {})
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=17, featuresCol="v", labelCol="label",
                          minInstancesPerNode=5).fit(sample.select("label", array_to_vector("f").alias("v")))
    trees = [t._call_java("rootNode") for t in model.trees]
    scorer = Scorer(trees, list(model.treeWeights), {})
    ranked = (test.select("kind", "label", "h", (F.floor(scorer.score(F.col("f")) * 1000) / 1000).alias("p")).distinct()
              .groupBy("kind", "p").agg(F.sum("label").alias("pos"), F.count("*").alias("n")).collect())
    for kind in range(len(KINDS)):
        rows = sorted(((r["p"], r["pos"], r["n"]) for r in ranked if r["kind"] == kind), reverse=True)
        pos = n = 0
        for p, a, b in rows:
            pos, n = pos + a, n + b
            if pos >= precision * n:
                scorer.thresholds[kind] = max(p, 0.5)
    return scorer


def find(docs: DataFrame, text: str = "text", base: str = "base", added: str = "added") -> DataFrame:
    """``docs`` with two columns of spans (start, end, kind), in code points, end exclusive: the base
    spans, and those the trees add (never one that a base span of its kind covers).

    Null and empty texts have no spans.  Repeated rows are searched each on its own.  No rows, or no
    labelled candidates of both classes: nothing is added.
    """
    cands = spare_name(docs.columns, "pii_candidates")
    found = stored(scan(docs, text, base, cands), "pii-spans")
    scorer = fit(found, cands)
    more = F.filter(F.col(cands), lambda c: (c["label"] < 0) & scorer.selects(c))
    return found.withColumn(added, F.array_sort(F.transform(more, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))).drop(cands)


def spans_text(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _in_order(spans: Column) -> Column:
    """Sorted by start, then kind as listed, then end."""
    return F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))), lambda s: s)


def op1_query(docs: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"))
    base, every = _in_order(F.col("base")), _in_order(F.concat("base", "added"))

    def n_of(i):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")

    counts = [n_of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
                        spans_text(every).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """Pipeline stage: all documents, each span of ``text`` replaced by its kind in brackets
    (overlapping spans by that of the first); ``n_chars`` follows the new text.

    Null texts stay null and empty ones empty; repeated rows are redacted each on its own, null ids do
    not matter; all other columns (any names) stay as they are.  No rows in: no rows out.
    """
    base, added = spare_name(docs.columns, "pii_base"), spare_name(docs.columns, "pii_added")
    found = find(docs, base=base, added=added)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("upto"), F.array().cast("array<string>").alias("out"))
    text = F.col("text").cast("string")

    def step(acc, s):
        gap = F.substring(text, acc["upto"] + 1, F.greatest(s["start"] - acc["upto"], F.lit(0)))
        fresh = s["start"] >= acc["upto"]
        return F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"),
                        F.when(fresh, F.array_append(F.array_append(acc["out"], gap), F.element_at(names, s["kind"] + 1)))
                        .otherwise(acc["out"]).alias("out"))

    new = F.aggregate(_in_order(F.concat(base, added)), start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["upto"] + 1, F.length(text))))
    out = found.withColumn("text", F.when(F.size(F.concat(base, added)) > 0, new).otherwise(text))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size(F.concat(base, added)) > 0, F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return out.select(docs.columns)
