"""Rule sets as data (J16, K1-K7): thousands of rule sets, one per season or format, score their lines in one job.

``scoring`` compiles one rule set into a Column. Here the rule sets are rows: the rules table of ``scoring.rules_frame``
with a column ``rule_set``. Each set becomes one row that holds its steps. A step is a per-unit rule or a group of
bands; a group's bounds are sorted into an array of edges, and its points listed for each cell, a cell being an edge or
a gap between two edges. So overlapping and touching bands, the first listed band, bands that add up and the inclusive
bounds are all decided once a rule set, and a line finds its cell by binary search in the edges. Names are resolved once
a rule set too: a step holds the places of its columns in an array of the line's stats, and a line takes each step's value once.

Defined results: a line whose rule set is null or unknown has null points. A null stat, a zero denominator, a guard
column that is null or too small, and a column that the lines lack give no points (``unknown_columns`` lists the last).
NaN lies above all edges. Equal rows of lines are scored alike and all kept; rule rows said twice count twice for
per-unit rules and bands that add up, and once for other bands. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scoring import DISMISSED

BROADCAST_BYTES = 64 << 20  # rule sets up to this size are broadcast, larger ones are joined by (rule set, salt)
SALTS = 32
_LINE = "_line"


def _covers(band: Column, edges: Column, cell: Column, stacked: Column) -> Column:
    """Whether a band covers a cell: odd cells are edges, cell 2k the gap below edge k."""
    k, m = F.floor(cell / 2).cast("int"), F.size(edges)
    at_edge = cell % 2 == 1
    low = F.when(at_edge, F.get(edges, k)).otherwise(F.get(edges, k - 1))   # null: below all edges
    high = F.get(edges, k)                                                  # null: above all edges
    from_below = band["min"].isNull() | F.coalesce(band["min"] <= low, F.lit(False))
    up_to = stacked | band["max"].isNull() | ((k < m) & F.coalesce(band["max"] >= high, F.lit(False)))
    return from_below & up_to


def _cells(bands: Column, edges: Column, stacked: Column) -> Column:
    def points(cell: Column) -> Column:
        hit = F.filter(bands, lambda b: _covers(b, edges, cell, stacked))
        total = F.aggregate(hit, F.lit(0.0), lambda a, b: a + b["points"])
        return F.when(stacked, total).otherwise(F.coalesce(F.get(hit, 0)["points"], F.lit(0.0)))

    return F.transform(F.sequence(F.lit(0), 2 * F.size(edges)), points)


def compile_rule_sets(rules: DataFrame, key: str = "rule_set") -> DataFrame:
    """The rules table with a rule-set column -> one row a rule set: ``key``, ``_steps`` in the order of section and group.

    A rule set is a document, so its steps fit a row; the number of rule sets is not bounded."""
    linear = F.col("kind") == "linear"
    step = ["section", "rule_group", "_step", "kind", "column", "denominator", "scale", "guard_column", "guard_min", "roles",
            "out_column", "out_value", "stacked"]
    named = rules.where(F.col(key).isNotNull()).withColumn("stacked", F.coalesce("stacked", F.lit(False))).withColumn(
        "_step", F.when(linear | F.col("stacked"), F.col("name")).otherwise(F.col("rule_group")))
    grouped = named.groupBy(key, *step).agg(
        F.array_sort(F.collect_list(F.struct("priority", "min", "max", "points", "name"))).alias("_bands"))
    bounds = F.concat(F.transform("_bands", lambda b: b["min"]), F.transform("_bands", lambda b: b["max"]))
    edged = grouped.withColumn("_edges", F.array_sort(F.array_distinct(F.filter(bounds, lambda x: x.isNotNull()))))
    unit = F.aggregate("_bands", F.lit(0.0), lambda a, b: a + b["points"])
    ready = edged.select(
        key, *step, F.when(linear, unit).alias("_unit"), "_edges",
        F.when(~linear, _cells(F.col("_bands"), F.col("_edges"), F.col("stacked"))).alias("_cells"),
        F.get("_bands", 0)["name"].alias("_first_name"),
        F.ceil(F.log2(F.size("_edges") + F.lit(1.0))).cast("int").alias("_depth"))
    fields = [*step, "_unit", "_edges", "_cells", "_first_name", "_depth"]
    return ready.groupBy(key).agg(F.array_sort(
        F.collect_list(F.struct(F.struct("section", "rule_group", "_step").alias("order"), F.to_json(F.struct(*fields[3:])).alias("id"),
                                F.struct(*fields).alias("step"))), _by_order).alias("_s")
    ).select(key, F.transform("_s", lambda x: x["step"]).alias("_steps"))


def _by_order(a: Column, b: Column) -> Column:
    return F.when(a["order"] < b["order"], -1).when(a["order"] > b["order"], 1).when(a["id"] < b["id"], -1).when(
        a["id"] > b["id"], 1).otherwise(0)


def _places(sets: DataFrame, key: str, stats: list[str], out_col: str) -> DataFrame:
    """``_steps`` as lines need them: column names become places among ``stats`` (-1: the lines lack it; null: none named), with
    the strides of the binary search; in ``_rates`` the set's distinct quotients, whose places follow those of ``stats``; in
    ``_sections`` the places of each section's steps. A step that asks for no condition is marked once a set."""
    named = F.create_map(*[x for i, c in enumerate(stats) for x in (F.lit(c), F.lit(i))]) if stats else F.lit(None).cast("map<string,int>")

    def place(name: Column) -> Column:
        return F.when(name.isNotNull(), F.coalesce(named[name], F.lit(-1)))

    def rate(s: Column) -> Column:
        return F.struct(place(s["column"]).alias("value"), s["scale"].alias("scale"), place(s["denominator"]).alias("denominator"))

    def step(s: Column) -> Column:
        flag = F.when(s["out_column"] == DISMISSED, F.lit(out_col)).otherwise(s["out_column"])
        strides = F.transform(F.sequence(s["_depth"] - 1, F.lit(0), F.lit(-1)), lambda d: F.pow(F.lit(2), d).cast("int"))
        ratio = F.lit(len(stats) - 1) + F.array_position("_rates", rate(s)).cast("int")
        checked = s["guard_column"].isNotNull() | s["roles"].isNotNull() | s["out_value"].isNotNull()
        return F.struct(
            (s["kind"] == "linear").alias("linear"), ((s["kind"] == "linear") & s["denominator"].isNull() & ~checked).alias("plain"),
            checked.alias("checked"), place(s["column"]).alias("raw"),
            F.when(s["denominator"].isNull(), place(s["column"])).otherwise(ratio).alias("value"),
            place(s["guard_column"]).alias("guard"), s["guard_min"].alias("guard_min"), s["roles"].alias("roles"),
            place(flag).alias("flag"), s["out_value"].cast("double").alias("out_value"), s["_unit"].alias("unit"),
            s["_edges"].alias("edges"), s["_cells"].alias("cells"),
            F.when(s["_depth"] > 0, strides).otherwise(F.array().cast("array<int>")).alias("strides"))

    rule = F.transform("_steps", lambda s: F.struct(s["section"].alias("section"), F.when(
        (s["kind"] == "band") & ~s["stacked"], s["rule_group"]).otherwise(s["_first_name"]).alias("rule")))
    every = F.col("_every")
    sections = F.transform(F.array_distinct(every), lambda x: F.struct(
        x.alias("section"), F.filter(F.sequence(F.lit(0), F.size(every) - 1), lambda i: F.get(every, i) == x).alias("places")))
    rates = F.array_distinct(F.transform(F.filter("_steps", lambda s: s["denominator"].isNotNull()), rate))
    listed = sets.withColumn("_rates", rates).select(
        key, F.transform("_steps", step).alias("_placed"), "_rates", rule.alias("_rules"), F.col("_steps")["section"].alias("_every"))
    return listed.select(key, F.col("_placed").alias("_steps"), "_rates", "_rules", sections.alias("_sections"))


def _cell(v: Column, step: Column) -> Column:
    """The cell of a value, by binary search: as many strides as the edges need. A stride is made if the edge that it passes
    lies below the value. Lambdas share no subexpressions, so the cell is made from the search's end: it is run once."""
    edges = step["edges"]
    return F.aggregate(step["strides"], F.lit(0), lambda lo, by: F.when(F.try_element_at(edges, lo + by) < v, lo + by).otherwise(lo),
                       lambda below: 2 * below + F.coalesce(F.get(edges, below) == v, F.lit(False)).cast("int"))


def _step_points(step: Column, v: Column, stats: Column, role: Column) -> Column:
    """Lambdas are not compiled, so a step looks at no more than it needs: a per-unit rule without a condition is one product.
    ``array_contains`` leaves its loop by an exception, which costs more than all else of a step; ``exists`` does not."""
    allowed = ~step["checked"] | (
        (step["guard"].isNull() | (F.get(stats, step["guard"]) >= step["guard_min"]))
        & (step["roles"].isNull() | F.exists(step["roles"], lambda r: r == role))
        & (step["out_value"].isNull() | (F.get(stats, step["flag"]) == step["out_value"])))
    banded = F.when(step["linear"], F.get(stats, step["raw"]) * step["unit"]).otherwise(F.get(step["cells"], _cell(v, step)))
    return F.coalesce(F.when(step["plain"], v * step["unit"]).when(v.isNotNull() & allowed, banded), F.lit(0.0))


def _stat_columns(lines: DataFrame) -> list[str]:
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    return [c for c, t in lines.dtypes if t in numeric or t.startswith("decimal")]


def _with_steps(lines: DataFrame, rules: DataFrame, key: str, stats: list[str], out_col: str, broadcast_bytes: int) -> DataFrame:
    """Lines with their rule set's steps. Rule sets are broadcast behind a count of their bytes; beyond it a rule set
    that holds a third of all lines is spread over ``SALTS`` tasks."""
    sets = _places(compile_rule_sets(rules, key), key, stats, out_col)
    size = sets.agg(F.sum(F.length(F.to_json(F.struct("_steps", "_rates", "_rules", "_sections"))))).first()[0] or 0
    if size <= broadcast_bytes:
        return lines.join(F.broadcast(sets), key, "left")
    salted = lines.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in lines.columns]), F.lit(SALTS)).cast("int"))
    copies = sets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def _points(lines: DataFrame, rules: DataFrame, key: str, role_col: str, out_col: str, broadcast_bytes: int) -> DataFrame:
    """``_line`` (the line as it came), its rule set's ``_rules`` and ``_sections``, and ``_p``: the points of every step."""
    names = _stat_columns(lines)
    row = lines.select(F.struct(*[F.col(f"`{c}`") for c in lines.columns]).alias(_LINE), F.col(f"`{key}`").alias(key),
                       F.col(f"`{role_col}`").alias("_role"))
    joined = _with_steps(row, rules, key, names, out_col, broadcast_bytes)
    stats, role = F.col("_stats"), F.col("_role")
    own = joined.withColumn("_own", F.array(*[F.col(_LINE)[c].cast("double") for c in names]).cast("array<double>"))
    ratios = F.transform("_rates", lambda r: F.try_divide(F.get("_own", r["value"]) * r["scale"], F.get("_own", r["denominator"])))
    valued = own.withColumn("_stats", F.concat("_own", ratios))
    values = F.transform("_steps", lambda s: F.get(stats, s["value"]))
    return valued.select(_LINE, "_rules", "_sections", F.zip_with(
        "_steps", values, lambda s, v: _step_points(s, v, stats, role)).alias("_p"))


def score_rule_sets(lines: DataFrame, rules: DataFrame, key: str = "rule_set", role_col: str = "role_std", out_col: str = "is_out",
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every line with ``section_points`` (a map) and ``total_points`` under the rule set that its ``key`` names."""
    p = _points(lines, rules, key, role_col, out_col, broadcast_bytes)
    summed = F.transform("_sections", lambda s: F.aggregate(
        s["places"], F.lit(0.0), lambda a, i: a + F.get("_p", i)))
    return p.select(f"{_LINE}.*", F.map_from_arrays(F.col("_sections")["section"], summed).alias("section_points"),
                    F.aggregate("_p", F.lit(0.0), lambda a, x: a + x).alias("total_points"))


def explain_rule_sets(lines: DataFrame, rules: DataFrame, keys: list[str], key: str = "rule_set", role_col: str = "role_std",
                      out_col: str = "is_out", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """K7: one row per (line, step that gives points): ``keys``, rule set, section, rule and points. A group of exclusive
    milestone or wicket bands goes by its group name."""
    p = _points(lines, rules, key, role_col, out_col, broadcast_bytes)
    names = list(dict.fromkeys([*keys, key]))
    each = p.select(_LINE, F.inline(F.arrays_zip("_rules", "_p")).alias("_rule", "_points")).where("_points <> 0")
    return each.select(*[F.col(_LINE)[k].alias(k) for k in names], F.col("_rule")["section"].alias("section"),
                       F.col("_rule")["rule"].alias("rule"), F.col("_points").alias("points"))


def unknown_columns(lines: DataFrame, rules: DataFrame, key: str = "rule_set", out_col: str = "is_out") -> DataFrame:
    """Columns that rules name and the lines lack: ``key``, rule name, column."""
    out = F.when(F.col("out_column") == DISMISSED, F.lit(out_col)).otherwise(F.col("out_column"))
    named = rules.select(key, "name", F.explode(F.array("column", "denominator", "guard_column", out)).alias("column"))
    return named.where(F.col("column").isNotNull() & ~F.col("column").isin(*_stat_columns(lines))).distinct()
