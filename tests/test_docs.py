"""Docs stay in sync with the catalog: every registered key is listed in the README coverage map."""

import os
import re

from ordermart.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_query_key_is_in_the_readme_coverage_map():
    readme = open(os.path.join(ROOT, "README.md"), encoding="utf-8").read()
    listed = set(re.findall(r"`([a-z0-9_]+)`", readme))
    sql = {k for k in catalog.queries() if k.startswith("sql_")}
    missing = {k for k in catalog.queries() if k not in listed} - (sql if "`sql_*`" in readme else set())
    missing -= {k for k in sql if k in listed}
    assert not missing, f"README coverage map misses: {sorted(missing)}"


def test_every_query_is_in_plans_md():
    plans = open(os.path.join(ROOT, "PLANS.md"), encoding="utf-8").read()
    rows = set(re.findall(r"^\| ([a-z0-9_]+) \|", plans, flags=re.M))
    assert set(catalog.queries()) <= rows
