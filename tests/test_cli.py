import argparse

from ordermart import cli
from ordermart.config import REFERENCE


def _args(**kw):
    base = dict(window_start=None, window_end=None, split_year=None)
    base.update(kw)
    return argparse.Namespace(**base)


def test_cli_defaults_are_reference_parameters():
    assert cli._params(_args()) == REFERENCE


def test_cli_overrides():
    p = cli._params(_args(window_start="1996-01-01", window_end="2000-12-31", split_year=2000))
    assert p.clean.start_date == "1996-01-01" and p.clean.end_date == "2000-12-31"
    assert p.forecast.split_year == 2000
    assert p.marts == REFERENCE.marts
