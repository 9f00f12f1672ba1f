"""From sparse observation rows to columns: one conditional aggregate per grain.

A mart asks for many columns, each fed by a few concepts. `collect_obs` reads the observations once,
keeps only the concepts asked for (a literal list, so the Parquet scan prunes on it), and computes all
columns in a single aggregate that combines on the map side.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.functions.scalars import live
from medloom.sources.codes import is_any


@dataclass(frozen=True)
class Obs:
    """One derived column.

    concepts, codes, where: which observations count (codes compare `value_coded`). Concepts may be None
    when codes are given: then any concept with such an answer counts.
    value: what to take from them; None means the constant 1.
    pick: "max", "min", "count", or "latest" (by obs_datetime, then obs_id).
    any_voided: also take observations that are voided or of unknown state.
    at: also emit `<name>_at`, the position of the picked row, so a later step can pick again.
    """

    concepts: tuple[int, ...] | list[int] | None
    codes: tuple[int, ...] | list[int] | None = None
    value: str | Column | None = None
    where: Column | None = None
    pick: str = "max"
    any_voided: bool = False
    at: bool = False

    def condition(self) -> Column:
        cond = F.lit(True) if self.concepts is None else is_any("concept_id", list(self.concepts))
        if self.codes is not None:
            cond = cond & is_any("value_coded", list(self.codes))
        if not self.any_voided:
            cond = cond & live()
        return cond if self.where is None else cond & self.where


POSITION = ("obs_datetime", "obs_id")


def _aggregate(name: str, spec: Obs) -> list[Column]:
    cond = spec.condition()
    value = F.lit(1) if spec.value is None else F.col(spec.value) if isinstance(spec.value, str) else spec.value
    place = F.when(cond, F.struct(*POSITION))
    if spec.pick == "latest":
        out = [F.max_by(value, place).alias(name)]
    elif spec.pick == "count":
        out = [F.count(F.when(cond, value)).alias(name)]
    else:
        out = [{"max": F.max, "min": F.min}[spec.pick](F.when(cond, value)).alias(name)]
    if spec.at:
        out.append(F.max(place).alias(f"{name}_at"))
    return out


def wanted(specs: dict[str, Obs]) -> Column:
    """Observations that feed at least one of the columns."""
    concepts = sorted({c for s in specs.values() for c in s.concepts or ()})
    answers = sorted({c for s in specs.values() if s.concepts is None for c in s.codes})
    cond = is_any("concept_id", concepts)
    if answers:
        cond = cond | is_any("value_coded", answers)
    if not any(s.any_voided for s in specs.values()):
        cond = cond & live()
    return cond


def collect_obs(obs: DataFrame, grain: str | list[str], specs: dict[str, Obs]) -> DataFrame:
    """One row per grain with all asked columns, from a single pass over the observations."""
    grain = [grain] if isinstance(grain, str) else grain
    aggs = reduce(list.__add__, (_aggregate(n, s) for n, s in specs.items()))
    return obs.filter(wanted(specs)).groupBy(*grain).agg(*aggs)


def many_facts(obs: DataFrame, grain: str | list[str], reports: dict[str, dict[str, Obs]]) -> DataFrame:
    """The columns of several reports from a single pass, named `<report>__<column>`; `facts_of` gives one report's back."""
    return collect_obs(obs, grain, {f"{r}__{n}": s for r, specs in reports.items() for n, s in specs.items()})


def facts_of(facts: DataFrame, report: str, *keys: str) -> DataFrame:
    """One report's columns by encounter and `keys`. The scan of a stored table reads no others."""
    own = [c for c in facts.columns if c.startswith(f"{report}__")]
    return facts.select("encounter_id", *keys, *[F.col(c).alias(c[len(report) + 2:]) for c in own])


def sibling_groups(obs: DataFrame, headers: list[int] | None, specs: dict[str, Obs]) -> DataFrame:
    """One row per observation group: its header and columns picked from its members.

    The header row and the members meet on the group id in one aggregate, so nothing is paired within
    a group. With `headers`, a group's header counts only when its concept is listed; groups without a
    listed header keep NULL header columns.
    """
    is_header = is_any("concept_id", list(headers or []))
    group_id = F.when(is_header, F.col("obs_id")).otherwise(F.col("obs_group_id"))
    aggs = reduce(list.__add__, (_aggregate(n, s) for n, s in specs.items()), [])
    member = wanted(specs) if specs else F.lit(False)
    return (
        obs.filter(is_header | member)
        .withColumn("group_id", group_id)
        .filter(F.col("group_id").isNotNull())
        .groupBy("group_id")
        .agg(
            F.max(F.when(is_header, F.col("concept_id"))).alias("header_concept"),
            F.max(F.when(is_header, F.col("person_id"))).alias("header_person"),
            F.max(F.when(is_header, F.col("encounter_id"))).alias("header_encounter"),
            *aggs,
        )
    )


def with_header(children: DataFrame, obs: DataFrame, headers: list[int], same_encounter: bool = True) -> DataFrame:
    """Children joined to the header of their group (unique per child), as `header_concept`.

    `same_encounter` also asks for the same person and encounter on both rows.
    """
    head = obs.filter(is_any("concept_id", list(headers))).select(
        F.col("obs_id").alias("obs_group_id"),
        F.col("concept_id").alias("header_concept"),
        F.col("person_id").alias("_hp"),
        F.col("encounter_id").alias("_he"),
    )
    joined = children.filter(F.col("obs_group_id").isNotNull()).join(head, "obs_group_id")
    if same_encounter:
        joined = joined.filter((F.col("_hp") == F.col("person_id")) & (F.col("_he") == F.col("encounter_id")))
    return joined.drop("_hp", "_he")


def sibling_pivot(
    obs: DataFrame, headers: list[int], answer: Column, specs: dict[str, Obs], same_encounter: bool = True
) -> DataFrame:
    """Answer rows of the listed groups, with columns picked from their siblings."""
    groups = sibling_groups(obs, headers, specs).filter(F.col("header_concept").isNotNull())
    rows = obs.filter(answer & F.col("obs_group_id").isNotNull()).join(
        groups, F.col("obs_group_id") == F.col("group_id")
    )
    if same_encounter:
        rows = rows.filter(
            (F.col("header_person") == F.col("person_id"))
            & (F.col("header_encounter") == F.col("encounter_id"))
        )
    return rows.drop("group_id", "header_person", "header_encounter")


def count_codes(df: DataFrame, grain: list[str], specs: dict[str, Column]) -> DataFrame:
    """How many rows of each grain satisfy each condition."""
    return df.groupBy(*grain).agg(*[F.count(F.when(c, 1)).alias(n) for n, c in specs.items()])
