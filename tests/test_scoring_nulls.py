"""A null stat scores nothing; the total equals the explained points."""

from pyspark.sql import functions as F

from anchorwise.operators import scoring


def test_null_stats_leave_the_group_alone(spark):
    rules = [r for r in scoring.flatten_rules(scoring.SCORING_RULES) if r.kind == "linear"]
    columns = sorted({r.column for r in rules})
    schema = "id long, " + ", ".join(f"`{c}` long" for c in columns)
    rows = [(0, *[3] * len(columns)), *[(k + 1, *[None if k == j else 3 for j in range(len(columns))]) for k in range(len(columns))], (99, *[None] * len(columns))]
    lines = spark.createDataFrame(rows, schema)
    total = {r["id"]: r["total_points"] for r in scoring.score_components(lines, rules).collect()}
    explained = dict(map(tuple, scoring.explain_scores(lines, ["id"], rules).groupBy("id").agg(F.sum("points")).collect()))
    assert total == {i: explained.get(i, 0) for i in total}
    assert total[99] == 0 and total[0] == sum(3 * r.points for r in rules)
