"""Data-quality rules as data: conditions that rows must meet, checked in one pass over a table.

A rule is a name, a condition in SQL, and a severity; a row breaks it when the condition is false or null. Rules
compose: ``all_of`` and ``any_of`` join conditions, ``where`` limits one to some rows. A ``unique`` rule is about
the table: of rows that share the columns' values, all but one break it, and rows with a null among them none.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

SEVERITIES = ("info", "warning", "error")
REPORT = "rule string, severity string, checked bigint, broken bigint"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str = "true"
    severity: str = "error"
    guard: str = "true"
    unique: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ValueError(f"rule {self.name}: severity {self.severity!r} is none of {SEVERITIES}")

    def where(self, guard: str) -> Rule:
        """The same rule for the rows where ``guard`` holds; others are not checked."""
        return Rule(self.name, self.condition, self.severity, f"({self.guard}) AND ({guard})", self.unique)

    def applies(self) -> Column:
        return F.coalesce(F.expr(self.guard), F.lit(False))

    def broken(self) -> Column:
        return self.applies() & ~F.coalesce(F.expr(self.condition), F.lit(False))

    def counts(self) -> list[Column]:
        """(checked, broken) of the whole table."""
        if not self.unique:
            return [F.count_if(self.applies()), F.count_if(self.broken())]
        whole = self.applies()
        for column in self.unique:
            whole = whole & F.col(column).isNotNull()
        keys = [F.when(whole, F.col(c)) for c in self.unique]
        checked = F.count_if(whole)
        return [checked, checked - F.count_distinct(*keys)]


def all_of(name: str, rules: Sequence[Rule], severity: str = "error") -> Rule:
    """Broken where any of the rules is; each counts only where its own guard holds."""
    return Rule(name, " AND ".join(f"(NOT coalesce({r.guard}, false) OR coalesce({r.condition}, false))" for r in rules) or "true", severity)


def any_of(name: str, rules: Sequence[Rule], severity: str = "error") -> Rule:
    """Broken where none of the rules holds."""
    return Rule(name, " OR ".join(f"(coalesce({r.guard}, false) AND coalesce({r.condition}, false))" for r in rules) or "false", severity)


def read_rules(rows: Iterable) -> dict[str, list[Rule]]:
    """Rules by table, from rows of table, rule, condition, severity, guard, unique (names parted by blanks); the last three may be empty."""
    out: dict[str, list[Rule]] = {}
    for row in rows:
        rule = Rule(row["rule"], row["condition"] or "true", row["severity"] or "error", row["guard"] or "true", tuple((row["unique"] or "").split()))
        if any(rule.name == r.name for r in out.setdefault(row["table"], [])):
            raise ValueError(f"table {row['table']} has two rules {rule.name}")
        out[row["table"]].append(rule)
    return out


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, severity, checked, broken) of each rule, from one aggregate over one scan of the columns they name.

    Only counts are moved: the partial sums of each task, and the distinct keys of unique rules. An empty table has
    all its rules with zeros; without rules there are no rows.
    """
    if not rules:
        return df.sparkSession.createDataFrame([], REPORT)
    counts = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), *(c.alias(n) for c, n in zip(r.counts(), ("checked", "broken")))) for r in rules]
    return df.agg(F.array(*counts).alias("rules")).select(F.inline("rules"))


def flagged(df: DataFrame, rules: Sequence[Rule], name: str = "broken") -> DataFrame:
    """``df`` with the names of the row rules that each row breaks, in the order of the rules."""
    marks = [F.when(r.broken(), F.lit(r.name)) for r in rules if not r.unique]
    return df.withColumn(name, F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>"))


def write_checked(df: DataFrame, rules: Sequence[Rule], path: str) -> dict[str, int]:
    """Write ``df`` to ``path/quality=kept`` and rows that break an ``error`` rule to ``path/quality=refused``.

    Both come from one pass, as do the counts returned: how many rows break each row rule, and ``rows``. Rows keep the names of
    the rules they break in ``broken``.
    """
    row_rules = [r for r in rules if not r.unique]
    errors = [r.name for r in row_rules if r.severity == "error"]
    seen = Observation()
    broken = [F.count_if(F.array_contains("broken", r.name)).alias(f"rule {i}") for i, r in enumerate(row_rules)]
    marked = flagged(df, row_rules).observe(seen, F.count(F.lit(1)).alias("rows"), *broken)
    bad = F.arrays_overlap("broken", F.array(*map(F.lit, errors))) if errors else F.lit(False)
    marked.withColumn("quality", F.when(bad, "refused").otherwise("kept")).write.mode("overwrite").partitionBy("quality").parquet(path)
    counts = seen.get
    return {"rows": counts["rows"], **{r.name: counts[f"rule {i}"] for i, r in enumerate(row_rules)}}


#: What the tables of a music build and of a places build must meet.
MUSIC_RULES = {
    "tracks": [
        Rule("id", unique=("id",)), Rule("title", "trim(title) <> ''"), Rule("artist", "trim(artist) <> ''", "warning"),
    ],
    "playlists": [Rule("id", unique=("id",)), Rule("name", "trim(name) <> ''")],
    "playlist_tracks": [Rule("ends", "playlist_id IS NOT NULL AND track_id IS NOT NULL")],
}
PLACE_RULES = {
    "places": [
        Rule("id", unique=("id",)), Rule("name", "trim(name) <> ''", "warning"),
        all_of("point", [Rule("lat", "lat BETWEEN -90 AND 90"), Rule("lon", "lon BETWEEN -180 AND 180")]).where("lat IS NOT NULL OR lon IS NOT NULL"),
        Rule("resolved", "lat IS NOT NULL", "info"),
    ],
    "lists": [Rule("id", unique=("id",)), Rule("type", "type IN ('my_maps', 'saved')")],
    "list_places": [Rule("ends", "list_id IS NOT NULL AND place_id IS NOT NULL"), Rule("link", unique=("list_id", "place_id"))],
}
