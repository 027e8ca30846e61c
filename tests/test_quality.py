from streakline.operators import quality
from streakline.operators.quality import Check
from streakline.session import stage
from streakline.sources import tables
from tests.test_plans import plan


def test_checks(spark):
    child = spark.createDataFrame(
        [(1, 10, "win"), (2, 10, None), (2, 99, "lost"), (None, None, "draw"), (None, 99, "win")], "id int, parent int, result string"
    )
    parent = spark.createDataFrame([(10,), (11,)], "id int")
    report = quality.quality_report(
        {"child": child, "parent": parent},
        [
            Check("child", "id", "not_null"),
            Check("child", "id", "unique"),
            Check("child", "result", "accepted_values", ("win", "draw", "loss")),
            Check("child", "parent", "relationship", (), ("parent", "id")),
            Check("parent", "id", "not_null"),
            Check("parent", "id", "unique"),
        ],
    )
    assert {(r.table, r.column, r.check): r.failing for r in report.collect()} == {
        ("child", "id", "not_null"): 2,
        ("child", "id", "unique"): 1,
        ("child", "result", "accepted_values"): 1,
        ("child", "parent", "relationship"): 2,
        ("parent", "id", "not_null"): 0,
        ("parent", "id", "unique"): 0,
    }
    orphans = quality.relationship_failures(child, "parent", parent, "id").collect()
    assert [tuple(r) for r in orphans] == [(99, 2)]


def test_writes_count_what_fails(spark, tmp_path):
    checks = [
        Check("t", "id", "not_null"),
        Check("t", "id", "unique"),
        Check("t", "result", "accepted_values", ("win", "draw")),
        Check("u", "id", "not_null"),
    ]
    df = spark.createDataFrame([(1, "win"), (None, "lost"), (1, None), (4, "lost")], "id int, result string").repartition(3)
    stored, counted = quality.counted_write(df, checks[:3], stage)
    assert {c[:3]: n for c, n in counted.items()} == {("t", "id", "not_null"): 1, ("t", "result", "accepted_values"): 2}
    none, of_none = quality.counted_write(df.limit(0), checks[3:], stage)
    assert list(of_none.values()) == [0]
    tables = {"t": stored, "u": none}
    report = quality.quality_report(tables, checks, {**counted, **of_none})
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(report) == rows(quality.quality_report(tables, checks))
    # Only the check for repeated values reads a table.
    assert plan(quality.quality_report(tables, checks, {**counted, **of_none})).count("FileScan") == 1


def test_check_models_takes_over_what_the_run_counted(spark, tmp_path):
    root = str(tmp_path)
    checks = [Check("m", "id", "not_null")]
    df = spark.createDataFrame([(1,), (None,)], "id int")
    tables.materialize(df, "table", "int/m", root, "1", checks=checks)
    assert tables.counted_checks(spark, root, "1", checks) == {checks[0]: 1}
    assert tables.counted_checks(spark, root, "2", checks) == {}
