"""Key and constraint checks as a data-quality report.

Parquet does not enforce constraints, so each check is a query returning
``(table, constraint, columns, violations)``. Every check aggregates before
it shuffles: duplicate keys via a partial+final count per key, foreign keys
by counting child rows per key first and anti-joining only the distinct
child keys against the parent keys. ``warehouse_report`` judges all tables
in one aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.schemas import FOREIGN_KEYS, RANGES, TABLE_KEYS, required_columns

REPORT_COLS = ["table", "constraint", "columns", "violations"]


def _row(df: DataFrame, table: str, constraint: str, columns: list[str]) -> DataFrame:
    return df.select(F.lit(table).alias("table"), F.lit(constraint).alias("constraint"),
                     F.lit(",".join(columns)).alias("columns"),
                     F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations"))


def check_primary_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Number of key values held by more than one row."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
           .agg(F.count_if(F.col("n") > 1).alias("violations")))
    return _row(dup, table, "primary_key", keys)


def check_foreign_key(child: DataFrame, parent: DataFrame, table: str,
                      child_keys: list[str], parent_keys: list[str] | None = None) -> DataFrame:
    """Child rows whose (non-null) key has no parent row."""
    parent_keys = parent_keys or child_keys
    per_key = (child.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in child_keys]))
               .groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n")))
    pk = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys, child_keys)]).distinct()
    orphans = per_key.join(pk, child_keys, "left_anti").agg(F.sum("n").alias("violations"))
    return _row(orphans, table, "foreign_key", child_keys)


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Nulls per required column, one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stacked = counts.select(F.stack(F.lit(len(columns)),
                                    *[x for c in columns for x in (F.lit(c), F.col(c))])
                            .alias("column", "violations"))
    return stacked.select(F.lit(table).alias("table"), F.lit("not_null").alias("constraint"),
                          F.col("column").alias("columns"),
                          F.col("violations").cast("long").alias("violations"))


def check_range(df: DataFrame, table: str, column: str, lo, hi) -> DataFrame:
    """Non-null values outside [lo, hi]."""
    c = F.col(column)
    bad = df.agg(F.count_if(c.isNotNull() & ~c.between(lo, hi)).alias("violations"))
    return _row(bad, table, f"range[{lo},{hi}]", [column])


def quality_report(checks: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks).select(*REPORT_COLS)


# ── all constraints of a warehouse at once ──────────────────────────────────
def _uses(tables: dict[str, DataFrame]) -> dict[tuple[str, tuple[str, ...]], tuple[int, int]]:
    """(table, key columns) -> (domain, place): keys that refer to each other share a domain, with
    the key referred to at place 0."""
    places: dict[tuple[str, tuple[str, ...]], tuple[int, int]] = {}
    sizes: list[int] = []
    for name in tables:
        places[name, tuple(TABLE_KEYS[name])] = (len(sizes), 0)
        sizes.append(1)
    for child, column, parent, parent_column in FOREIGN_KEYS:
        if child in tables and parent in tables and column in tables[child].columns:
            domain, _ = places[parent, (parent_column,)]
            places[child, (column,)] = (domain, sizes[domain])
            sizes[domain] += 1
    return places


def warehouse_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared constraint of the given warehouse tables (see schemas): primary and foreign keys,
    required columns, value ranges. A foreign key counts if both tables are given.

    Each table is read once, with only the columns its constraints name. A row says which keys it
    holds, as (domain, place, key), and which rules its values break, if any; those facts of all
    tables go through one aggregate by (domain, key), whose counts per place show repeated keys and
    keys without a parent. Counts start on the map side, so a hot key is one row of each task."""
    # Expressions are SQL text: one call to the JVM for each of the many columns.
    places = _uses(tables)
    width = max(place for _, place in places.values()) + 1
    rule_domain = len(places)  # here a key is (table, which of its rules a row breaks)
    foreign = {(child, (column,)) for child, column, _, _ in FOREIGN_KEYS}
    facts, sums, report = [], [], []  # report: (table, constraint, columns, violations in the row of totals)
    for t, (name, df) in enumerate(tables.items()):
        found = []
        for (table, columns), (domain, place) in places.items():
            if table != name:
                continue
            key = ", ".join(f"CAST(`{c}` AS STRING)" for c in columns)
            held = f"named_struct('domain', {domain}, 'place', {place}, 'key', array({key}))"
            if columns == tuple(TABLE_KEYS[name]):
                report.append((name, "primary_key", ",".join(columns), f"v{len(sums)}"))
                sums.append(f"count_if(domain = {domain} AND n{place} > 1)")
            else:
                held = f"IF(`{columns[0]}` IS NOT NULL, {held}, NULL)"
            if place and (name, columns) in foreign:  # foreign keys are single columns
                report.append((name, "foreign_key", ",".join(columns), f"v{len(sums)}"))
                sums.append(f"sum(IF(domain = {domain} AND n0 = 0 AND get(key, 0) IS NOT NULL, n{place}, 0))")
            found.append(held)
        rules = [("not_null", c, f"`{c}` IS NULL") for c in required_columns(name) if c in df.columns]
        rules += [(f"range[{lo},{hi}]", c, f"`{c}` NOT BETWEEN {lo} AND {hi}") for c, (lo, hi) in RANGES.get(name, {}).items()]
        broken = "concat(" + ", ".join(f"IF({bad}, '1', '0')" for _, _, bad in rules) + ")"
        found.append(f"IF(contains({broken}, '1'), named_struct('domain', {rule_domain}, 'place', 0, 'key', array('{t}', {broken})), NULL)")
        for k, (constraint, column, _) in enumerate(rules):
            report.append((name, constraint, column, f"aggregate(filter(broken, b -> b.key[0] = '{t}' AND substr(b.key[1], {k + 1}, 1) = '1'), "
                                                     "0L, (n, b) -> n + b.n0)"))
        facts.append(df.selectExpr(f"inline(array({', '.join(found)}))").where("domain IS NOT NULL"))
    counts = reduce(DataFrame.unionByName, facts).groupBy("domain", "key").agg(
        *[F.expr(f"count_if(place = {p})").alias(f"n{p}") for p in range(width)])
    # One row: a count per key constraint, and the sets of broken rules (as many as differ).
    totals = counts.agg(*[F.expr(v).alias(f"v{k}") for k, v in enumerate(sums)],
                        F.expr(f"collect_list(IF(domain = {rule_domain}, struct(key, n0), NULL))").alias("broken"))
    rows = ", ".join(f"named_struct('table', '{t}', 'constraint', '{c}', 'columns', '{cols}', 'violations', CAST(coalesce({v}, 0) AS BIGINT))"
                     for t, c, cols, v in report)
    return totals.selectExpr(f"inline(array({rows}))").select(*REPORT_COLS)
