import hashlib
import re

from pyspark.sql import functions as F

from ordermart.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for i, kind in enumerate(pii.KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), i, m.end()))
    return sorted(out)


TEXTS = [
    None, "", "plain", "a@b.co", "x.y+z@host-1.example.org.", "a@b.c+d@e.f", "@b.c a@ b@c a@b..c", "a@b.com@c.de", "é@x.yz 中a@b.c",
    "1.2.3.4", "1.2.3", "1.2.3.4.5.6.7.8", "300.1.1.1 001.002.003.004 255.255.255.256", "v1.2.3.4x", "4111111111111111",
    "4111 1111 1111 1111 and 4111-1111-1111-1111", "4111111111111112", "4111111111111111 4111111111111111", "1 2 3 4 5 6 7 8 9 0 1",
    "0000 0000 0000", "12  34", "+1 (826) 555-4081", "+1 (826) 555-4081 190.137.223.204", "+12345678", "+1 234 567 89 ", "+ 1", "++123456789",
    "+1.....2 +123456789012345 +1234567890123456", "tel 555-123-4567, (555) 123-4567 x555-123-45678", "card: 4111 1111 1111 1111.",
    "me (at) there.org or me[at]there[dot]org", "\U0001F600 a@b.co \U0001F600 1.1.1.1", "a@b.co\n+49 89 1234567\n10.0.0.1\n378282246310005",
]


def test_base_spans_equal_brute_force(spark, make_docs, texts):
    rows = list(enumerate(TEXTS)) + [(1000 + i, t) for i, t in texts]
    got = pii.op1_query(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        want = brute(t)
        line = ",".join(f"{pii.KINDS[k]}:{a}:{e}" for a, k, e in want)
        r = by[i]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (t, r.spans, line)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))


def test_long_single_class_texts_are_searched_in_linear_time(make_docs):
    n = 20_000
    rows = [(i, c * n) for i, c in enumerate(["a", "1", "a.", "1.", "1 ", "+1", "+1 ", "a@", "@a", "a@b.", "(", "-", "1-"])]
    got = {r.doc_id: r for r in pii.op1_query(make_docs(rows, 8)).collect()}
    assert got[0].n_email == 0 and got[1].n_card == 0 and got[3].n_ip == n // 4


def test_positions_beyond_one_run_of_matches(make_docs):
    text = " ".join(f"u{i}@h{i}.org" for i in range(700))
    spans = pii.op1_query(make_docs([(1, text)])).first().spans.split(",")
    assert len(spans) == 700 and spans == [f"email:{a}:{e}" for a, _, e in brute(text)]


def test_labels_beyond_one_run_of_spans(make_docs):
    """Which candidates a base span holds, with more spans than one run and kinds in between."""
    text = " ".join(f"u{i}@h{i}.org 10.{i % 250}.0.7 300.{i % 250}.0.7" for i in range(700))
    row = pii.scan(make_docs([(1, text)]), "text", "base", "cands").first()
    held = {(b.start, b.end, b.kind) for b in row.base}
    assert len(row.cands) > 1400
    for c in row.cands:
        inside = any(k == c.kind and a <= c.start and e >= c.end for a, e, k in held if k == c.kind and a <= c.start)
        assert (c.label == 1) == inside


def test_trees_add_spans_that_base_patterns_lose(make_docs):
    rows = []
    for i in range(150):
        d = f"{i:03d}"
        rows.append((i, f"please call +1 (555) {d}-{4000 + i} now, or the id 12{d}-555-{d}-{5000 + i}88 x{d}-{d}-{4000 + i}"))
    rows.append((1000, "call me at (555) 321-7654 now"))
    rows.append((1001, "nothing 321-765 here"))
    got = {r.doc_id: r for r in pii.op1_query(make_docs(rows)).collect()}
    assert got[1000].n_phone == 0 and got[1000].spans == "phone:11:25"
    assert got[1001].spans == ""


def test_each_kind_adds_spans_in_other_layouts(make_docs):
    rows = []
    for i in range(150):
        d, e = f"{i:03d}", f"{i % 100:02d}"
        rows.append((i, f"call +1 (555) {d}-{4000 + i} or +33 01 {e} 45 67 89, +44 20 7946 0{d}, +1 5557{d}{200 + i}, not the id x{d}-{d}-{4000 + i}; "
                        f"server 10.{i}.0.7 not 999.{i}.0.7; write u{i}@h{i}.org or first.last{i}@mail.example.org, we met @ h{i}. Then"
                        f" pay 4111 1111 1111 1111, not 4111 1111 1111 {4112 + i}; pay 5500000000000004 or not 550000000000{1005 + i}"))
    new = ["(555)123-4567", "01 23 45 67 89", "030 1234567", "0044 20 7946 0958", "612 345 678"]
    want = {1000 + i: ("phone", t) for i, t in enumerate(new)}
    want |= {1100: ("ip", "10[.]1[.]0[.]9"), 1101: ("ip", "10 . 1 . 0 . 9"), 1102: ("email", "me (at) there.org"),
             1103: ("ip", "10[dot]1[dot]0[dot]9"), 1104: ("card", "4111111111111111")}
    before = {"phone": "call ", "ip": "server ", "email": "write ", "card": "pay "}
    rows += [(i, before[k] + t + " now") for i, (k, t) in want.items()]
    rows[-1] = (1104, "pay 12 4111111111111111 now")
    rows += [(1200, "server 10[.]1[.]0[.]999 now"), (1201, "we met @ noon. Then")]
    got = {r.doc_id: (r.spans, t) for r, t in ((r, dict(rows)[r.doc_id]) for r in pii.op1_query(make_docs(rows)).collect())}
    for i, (kind, value) in want.items():
        a = got[i][1].index(value)
        assert f"{kind}:{a}:{a + len(value)}" in got[i][0].split(","), got[i]
    assert got[1200][0] == "" and got[1201][0] == ""


def test_a_frequent_kind_or_text_displaces_no_other(make_docs):
    """Bounded to 100 candidates: 6,000 addresses and 300 copies of a text leave the phone numbers theirs."""
    rows = [(i, " ".join(f"10.{i}.{j}.7 300.{i}.{j}.7" for j in range(100))) for i in range(30)]
    rows += [(100 + i, "mail a@b.co or 10.0.0.1, call +1 (555) 765-4321") for i in range(300)]
    rows += [(500 + i, f"call +1 (555) {i:03d}-{4000 + i} now, or the id x{i:03d}-{i:03d}-{4000 + i}") for i in range(40)]
    found = pii.scan(make_docs(rows), "text", "base", "cands").persist()
    scorer = pii.fit(found, "cands", train_rows=100)
    assert {pii.KINDS.index("ip"), pii.KINDS.index("phone")} <= set(scorer.thresholds)
    found.unpersist()


def test_shares_of_the_sample():
    assert pii._shares({"a": 10, "b": 1000, "c": 100}, 150) == {"a": 1.0, "c": 0.7, "b": 0.07}
    assert pii._shares({"a": 10, "b": 20}, 150) == {"a": 1.0, "b": 1.0}


def test_redaction_and_clashing_columns(spark, make_docs):
    docs = make_docs([(1, "mail a@b.co or 10.0.0.1!"), (2, None), (3, "clean"), (1, "mail a@b.co or 10.0.0.1!")])
    docs = docs.withColumn("pii_text", F.lit("keep")).withColumn("base", F.lit(1)).withColumn("pii_candidates", F.lit(2))
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.n_chars, r.pii_text) for r in out.collect()), key=repr)
    new = "mail [EMAIL] or [IP]!"
    assert got == sorted([(1, new, len(new), "keep")] * 2 + [(2, None, 0, "keep"), (3, "clean", 5, "keep")], key=repr)
    assert pii.redact(docs.limit(0)).count() == 0 and pii.op1_query(docs.limit(0)).count() == 0
