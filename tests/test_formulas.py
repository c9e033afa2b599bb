"""The formula tree, the division guard as text and as a column, and planning."""

import random

import pytest
from pyspark.sql import functions as F

from tractlake.operators import catalog as cat
from tractlake.operators import formulas as fm

GUARDED = {
    "a / b": "a / NULLIF(b, 0)", "a/b": "a/ NULLIF(b, 0)", "a / -b": "a / NULLIF(-b, 0)",
    "a / - b + c": "a / NULLIF(- b, 0) + c", "a / (b + c) / d": "a / NULLIF((b + c), 0) / NULLIF(d, 0)",
    "a / NULLIF(b, 0)": "a / NULLIF(b, 0)", "a /nullif (b, 0)": "a /nullif (b, 0)", "a": "a", "a % b": "a % NULLIF(b, 0)",
    "a / abs(b / c)": "a / NULLIF(abs(b / NULLIF(c, 0)), 0)", 'a / "b c" - 1': 'a / NULLIF("b c", 0) - 1',
    "a / `b/c`": "a / NULLIF(`b/c`, 0)", "1.5 / 2e1": "1.5 / NULLIF(2e1, 0)", "-(a / b) * c": "-(a / NULLIF(b, 0)) * c",
    "a / +-b": "a / NULLIF(+-b, 0)", "a / ((b))": "a / NULLIF(((b)), 0)", " a / b ": " a / NULLIF(b, 0) ",
}


def _deep(n):
    f, want = "x", "x"
    for _ in range(n):
        f, want = f"a / ({f})", f"a / NULLIF(({want}), 0)"
    return f, want


def _random(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice(["a", "B01_002", "3", "0.5", '"q r"', "`z`"])
    x, y = _random(rng, depth - 1), _random(rng, depth - 1)
    blank = rng.choice(["", " ", "  "])
    return rng.choice([f"{x}{blank}+{blank}{y}", f"{x}{blank}/{blank}{y}", f"({x}{blank}- {y})", f"{x} / ({y})",
                       f"abs({x}, {y})", f"{x} / {rng.choice('+-')}{blank}({y})", f"coalesce ( {x} ) / least({y})",
                       f"{x} * NULLIF({y}, 0)", f"{x} / nullif({y}, 0)", f"{x} % {y}"])


def test_guard_as_text_and_column(spark):
    rng = random.Random(4)
    cases = {**GUARDED, **dict([_deep(n) for n in (1, 8, 60)])}
    for f, want in cases.items():
        assert fm.guard_text(f) == want
        assert fm.guard_text(want) == want
    made = [*cases, *[_random(rng, 5) for _ in range(300)]]
    got = spark.createDataFrame([(f,) for f in made], "f string").select("f", fm.guard_division("f").alias("g")).collect()
    for r in got:
        assert r.g == fm.guard_text(r.f)


def test_no_limit_of_depth():
    f, want = _deep(5000)
    assert fm.guard_text(f) == want


def test_divisions_by_zero_are_null(spark):
    row = spark.createDataFrame([(6, 0, 3)], "a int, b int, c int")
    zero = ["a / b", "a / -b", "a / (b * c)", "a / (c / (a / (c / (a / (c / (a / (c / b)))))))", "a / `b`", "a % b", "a / abs(b)"]
    got = row.select(*[F.expr(fm.guard_text(f)).alias(f"x{i}") for i, f in enumerate(zero)],
                     F.expr(fm.guard_text("a / -c")).alias("ok")).first()
    assert all(got[i] is None for i in range(len(zero))) and got["ok"] == -2


def test_tree_binds_as_sql_does(spark):
    rng = random.Random(8)
    row = spark.createDataFrame([(7.0, 2.0, 5.0)], "a double, B01_002 double, z double")

    def value(n, env):
        if n.kind == "number":
            return float(n.text)
        if n.kind == "name":
            return env[fm.unquoted(n.text)]
        if n.kind == "sign":
            return value(n.parts[0], env) * (-1 if n.text == "-" else 1)
        if n.kind == "group":
            return value(n.parts[0], env)
        x, y = (value(p, env) for p in n.parts)
        return {"+": lambda: x + y, "-": lambda: x - y, "*": lambda: x * y, "/": lambda: x / y}[n.text]()
    def make(d):
        if d == 0:
            return rng.choice(["a", "B01_002", "`z`", "3.0"])
        op = rng.choice(["+", "-", "*", "/"])
        body = f"{make(d - 1)} {op} {rng.choice(['', '- ', '+'])}{make(d - 1)}"
        return rng.choice([body, f"({body})", f"- ({body})"])
    made = []
    while len(made) < 80:
        f = make(3)
        try:
            made.append((f, value(fm.parse(f), {"a": 7.0, "B01_002": 2.0, "z": 5.0})))
        except ZeroDivisionError:
            pass
    got = row.select(*[F.expr(f).cast("double").alias(f"x{i}") for i, (f, _) in enumerate(made)]).first()
    assert [pytest.approx(w, rel=1e-9) for _, w in made] == list(got)


@pytest.mark.parametrize("bad, why", [
    ("a +", "no operand at the end"), ("(a", "without '\\)'"), ("a)", "without '\\('"), ("a b", "no operator"),
    ("evil(a)", "unknown function 'evil'"), ("a; drop", "cannot read"), ("a / * b", "no operand"), ("", "no operand"),
    ("(a, b)", "outside a call"), ("3(a)", "cannot be called"), ("()", "no operand"), ("a --a", "comment"), ("a 'x'", "cannot read")])
def test_refused_at_planning(bad, why):
    with pytest.raises(fm.FormulaError, match=why):
        fm.parse(bad)
    row = dict(group_name="g", metric_name="m", formula=bad.replace("a", "B1_1"), statistic="count", start_year=1, end_year=2)
    with pytest.raises(cat.CatalogError):
        cat.plan_groups([row], 2)


def test_planning_with_quoted_names(spark):
    rows = [dict(group_name="g", metric_name=n, formula=f, statistic="rate", start_year=1, end_year=9999)
            for n, f in (("total sum", "B1_001 + `B1_002`"), ("share", 'B1_001 / -"Total Sum"'))]
    plan, = cat.plan_groups(rows, 5)
    assert plan.measures == ["B1_001", "B1_002"]
    row = spark.createDataFrame([(1, 3), (1, -1)], "B1_001 int, B1_002 int")
    assert [r[0] for r in row.select(F.expr(dict(plan.metrics)["share"])).collect()] == [-0.25, None]
