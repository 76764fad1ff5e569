"""Every case of the scalar rules."""

import pytest

from .rule_cases import GROUPS, rows


@pytest.mark.parametrize("group", list(GROUPS))
def test_cases(spark, group):
    want = {(name, " ; ".join(c) if isinstance(c, tuple) else c): v for name, (_, cases) in GROUPS[group].items() for c, v in cases.items()}
    assert {(r.rule, r.input): r.result for r in rows(spark, group).collect()} == want
