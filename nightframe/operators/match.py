"""Matching files to primaries.

A rule names the columns a candidate must share with the primary. All candidates with the
same key form a *match set*. Sets are kept factored: one table of members ``(key, file)`` and
per primary the key, the set's size and its first member. Both tables are linear in the
catalogue, even if one key holds a third of all files; the primary-by-candidate pairs are
only written out by ``all_matches`` for the primaries a caller asks about.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightframe import schemas


@dataclass(frozen=True)
class MatchRule:
    file_type: str
    keys: tuple[str, ...] = ()  # empty: every primary shares one match set
    #: Instead of keys: a function of primaries and the type's files that gives ``file_path, match_path`` pairs.
    pairs: Callable[[DataFrame, DataFrame], DataFrame] | None = None

    @property
    def is_global(self) -> bool:
        return not self.keys and self.pairs is None


class MatchRegistry:
    def __init__(self) -> None:
        self._rules: dict[str, MatchRule] = {}

    def register(self, rule: MatchRule) -> MatchRule:
        if rule.file_type in self._rules:
            raise ValueError(f"a match rule for {rule.file_type} is already registered")
        self._rules[rule.file_type] = rule
        return rule

    def rule(self, file_type: str) -> MatchRule:
        if file_type not in self._rules:
            raise KeyError(f"no match rule for {file_type}")
        return self._rules[file_type]


registry = MatchRegistry()
for _rule in (
    MatchRule(schemas.ARC, ("run_id", "object", "channel")),
    MatchRule(schemas.CONTINUUM, ("run_id", "object", "channel")),
    MatchRule(schemas.BINARY_OFFSET_MODEL, ("channel",)),
    MatchRule(schemas.RAW_LOGS, ()),
    MatchRule(schemas.WEATHER, ()),
):
    registry.register(_rule)


def members(file_type: str, catalog: DataFrame) -> DataFrame:
    """All match sets of a type: key columns and ``match_path``. A null key matches nothing."""
    rule = registry.rule(file_type)
    if rule.pairs:
        raise ValueError(f"{file_type} is matched by a function and has no sets: use all_matches()")
    files = catalog.filter(F.col("type") == rule.file_type)
    if rule.keys:
        files = files.dropna(subset=list(rule.keys))
    return files.select(*rule.keys, F.col("file_path").alias("match_path"))


def set_summary(file_type: str, catalog: DataFrame, salted: bool = False) -> DataFrame:
    """Per match set its size and its first member in path order; ``salted`` adds ``_salt``, 0."""
    rule = registry.rule(file_type)
    # an aggregate, as a literal would be moved out of the join's keys
    salt = [F.min(F.lit(0).cast("long")).alias("_salt")] if salted else []
    return members(file_type, catalog).groupBy(*rule.keys).agg(
        F.count("*").alias("n_matches"), F.min("match_path").alias("match_path"), *salt
    )


def first_match(
    file_type: str, primaries: DataFrame, catalog: DataFrame, strict: bool = False
) -> DataFrame:
    """Primaries with ``n_matches`` and the first ``match_path``; none is an error when strict.

    The join meets one row per key, so AQE can split a hot key on the primaries' side. A
    global rule needs no join at all: its single summary row is a scalar subquery.
    """
    rule = registry.rule(file_type)
    summary = None if rule.pairs else set_summary(file_type, catalog, salted=bool(rule.keys))
    if rule.pairs:
        chosen = all_matches(file_type, primaries, catalog).groupBy("file_path").agg(
            F.count("*").alias("n_matches"), F.min("match_path").alias("match_path")
        )
        found = primaries.join(chosen, "file_path", "left")
    elif rule.is_global:
        found = primaries.withColumns(
            {
                "n_matches": summary.select("n_matches").scalar(),
                "match_path": summary.select("match_path").scalar(),
            }
        )
    else:
        # a null key matches nothing: a salt spreads such primaries over the tasks of the one join
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in rule.keys])
        salt = F.when(known, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("file_path"), F.lit(1 << 20)))
        found = primaries.withColumn("_salt", salt.cast("long")).join(summary, [*rule.keys, "_salt"], "left").drop("_salt")
    found = found.withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
    if strict:
        message = F.concat(
            F.lit(f"no matches found for {file_type} for primary file "), F.col("file_path")
        )
        found = found.withColumn(
            "match_path", F.coalesce("match_path", F.raise_error(message).cast("string"))
        )
    return found


def all_matches(file_type: str, primaries: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every match of the given primaries: ``(file_path, match_path)``.

    The result is as large as the answer; pass the primaries of interest. A rule without keys
    has the same answer for every primary: read it from :func:`members`.
    """
    rule = registry.rule(file_type)
    if rule.is_global:
        raise ValueError(f"{file_type} has one match set for all primaries: use members()")
    if rule.pairs:
        files = catalog.filter(F.col("type") == rule.file_type)
        return rule.pairs(primaries, files).select("file_path", "match_path").distinct()
    keyed = primaries.select("file_path", *rule.keys)
    return keyed.join(members(file_type, catalog), list(rule.keys)).select("file_path", "match_path")


def _attach(
    resolved: DataFrame, name: str, file_type: str, catalog: DataFrame, strict: bool
) -> DataFrame:
    """Column ``name``: the given value if there is one, else the first match."""
    given = F.col(name) if name in resolved.columns else F.lit(None).cast("string")
    found = first_match(file_type, resolved, catalog)
    value = F.coalesce(given, F.col("match_path"))
    if strict:
        message = F.concat(F.lit(f"no matches found for {file_type} for primary file "), F.col("file_path"))
        value = F.coalesce(value, F.raise_error(message).cast("string"))
    return found.withColumn(name, value).drop("n_matches", "match_path")


def resolve_continuum(primaries: DataFrame, catalog: DataFrame, strict: bool = False) -> DataFrame:
    """Inputs of continuum exposures: one arc and one weather file; given values win."""
    resolved = _attach(primaries, "arc_file", schemas.ARC, catalog, strict)
    return _attach(resolved, "weather_file", schemas.WEATHER, catalog, strict)


def resolve_science(primaries: DataFrame, catalog: DataFrame, strict: bool = False) -> DataFrame:
    """Inputs of science exposures: one arc, one weather file and the set of flats.

    The flats are named by their set (run, object, channel) with its size and first member;
    the files of a set are in ``members(CONTINUUM, catalog)``. A non-empty given list
    ``continuum_files`` wins.
    """
    resolved = resolve_continuum(primaries, catalog, strict)
    found = first_match(schemas.CONTINUUM, resolved, catalog)
    n, first = F.col("n_matches"), F.col("match_path")
    if "continuum_files" in primaries.columns:
        given = F.size("continuum_files") > 0
        n = F.when(given, F.size("continuum_files").cast("long")).otherwise(n)
        first = F.when(given, F.get("continuum_files", F.lit(0))).otherwise(first)
    return found.withColumns({"n_flats": n, "first_flat": first}).drop("n_matches", "match_path")


def continuum_files(resolved: DataFrame, catalog: DataFrame) -> DataFrame:
    """The flats of chosen science primaries: ``(file_path, match_path)``; a given list wins."""
    if "continuum_files" not in resolved.columns:
        return all_matches(schemas.CONTINUUM, resolved, catalog)
    given = resolved.filter(F.size("continuum_files") > 0)
    rest = resolved.filter(F.coalesce(F.size("continuum_files"), F.lit(0)) <= 0)
    listed = given.select("file_path", F.explode("continuum_files").alias("match_path"))
    return listed.unionByName(all_matches(schemas.CONTINUUM, rest, catalog))


def models_of_exposures(exposures: DataFrame, catalog: DataFrame, models: DataFrame) -> DataFrame:
    """Bit-offset parameters per channel, from the first model file of the catalogue.

    ``models`` has ``(file_path, parameters)`` with catalogue paths.
    """
    summary = set_summary(schemas.BINARY_OFFSET_MODEL, catalog)
    chosen = models.select(F.col("file_path").alias("match_path"), "parameters")
    wanted = exposures.select("channel").distinct().join(summary, "channel")
    return wanted.join(chosen, "match_path").select("channel", "parameters")
