"""Marts that follow a keyed silver table by its changes.

Each mart keeps one row per key in a table of its own, together with the version of the
silver table it stands for; both become visible with one manifest. An update reads only the silver
buckets written since that version, so late corrections and rows that change
their key cost what they touch. An update that failed changes nothing and is repeated; one
without new versions writes nothing. NULL values in a key form a group, as they do in ``groupBy``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.names import col
from tierline.functions.spread import materialize, scratch_folders
from tierline.operators.bucket_table import BucketTable

_SIGN, _KEY, _ROWS, _FILLED = "__sign", "__key", "__rows", "__filled_{}"


def _spelled(key: Mapping[str, str]) -> Column:
    """A text per key that is never NULL; JSON leaves NULL fields out, so they differ from all values."""
    return F.to_json(F.struct(*[col(c).alias(name) for c, name in key.items()]))


class _Following:
    """``key`` names columns of silver, as a mapping with their names in the mart."""

    def __init__(self, source: BucketTable, state: BucketTable, key: list[str] | Mapping[str, str]):
        self.source, self.state = source, state
        self.key = dict(key) if isinstance(key, Mapping) else {k: k for k in key}

    def _delta(self, signed: DataFrame) -> DataFrame:
        """What changed, by key."""
        raise NotImplementedError

    def _next(self, delta: DataFrame, old: DataFrame | None, until: int) -> DataFrame:
        """The rows to be written on top of ``old``."""
        raise NotImplementedError

    def _anew(self, delta: DataFrame, old: DataFrame, until: int) -> DataFrame:
        """The rows to be written where ``delta`` is all of silver and ``old`` counts no longer."""
        raise NotImplementedError

    def followed(self) -> int:
        """The silver version that the mart stands for; 0 before the first update."""
        manifest = self.state.manifest()
        return manifest.note["source"] if manifest else 0

    def update(self) -> DataFrame | None:
        """Takes in what silver got since the last update and returns the mart; all of silver where that version was removed."""
        before, versions = self.state.manifest(), self.source.versions()
        since = before.note["source"] if before else 0
        if versions and versions[-1] > since:
            until = versions[-1]
            old = self.state.read(before.version) if before else None
            with scratch_folders(self.source.spark):
                known = since in versions
                delta = materialize(self._delta(self.source.changes(since if known else 0, until, _SIGN)), "delta")
                rows = self._next(delta, old, until) if known or old is None else self._anew(delta, old, until)
                self.state.upsert_from(before, rows, [_KEY], [], {"source": until})
        return self.read()

    def read(self) -> DataFrame | None:
        """One row per key that has rows in silver."""
        kept = self.state.read()
        return None if kept is None else kept.filter(F.col(_ROWS) > 0).drop(_KEY, _ROWS)


class SumMart(_Following):
    """Counts and sums per key, kept by adding what new rows bring and taking off what replaced rows held.

    ``count`` names the number of rows, ``sums`` the column that each sum is of. Sums are of whole numbers or decimals, whose
    differences are exact. A sum without values is NULL. Keys that lost all rows stay with a count of zero and are not shown.
    """

    def __init__(self, source: BucketTable, state: BucketTable, key: list[str] | Mapping[str, str], sums: Mapping[str, str], *, count: str):
        super().__init__(source, state, key)
        self.sums, self.count = dict(sums), count

    def _delta(self, signed: DataFrame) -> DataFrame:
        odd = [c for c in self.sums.values() if not isinstance(signed.schema[c].dataType, (T.DecimalType, T.IntegralType))]
        if odd:
            raise ValueError(f"sums that are kept need whole numbers or decimals: {odd}")
        up = F.col(_SIGN) > 0
        values = {n: col(c).cast("long") if isinstance(signed.schema[c].dataType, T.IntegralType) else col(c) for n, c in self.sums.items()}
        # A sum of decimals has ten digits more than its values; the table keeps that type.
        kinds = {n: signed.select(F.sum(v)).schema[0].dataType for n, v in values.items()}
        found = signed.groupBy(*[col(k) for k in self.key]).agg(
            F.sum(_SIGN).cast("long").alias(_ROWS),
            *[F.coalesce(F.sum(F.when(up, v).otherwise(-v)), F.lit(0)).cast(kinds[n]).alias(n) for n, v in values.items()],
            *[F.sum(F.when(v.isNotNull(), F.col(_SIGN)).otherwise(0)).cast("long").alias(_FILLED.format(n)) for n, v in values.items()],
        )
        moved = reduce(or_, [col(c) != 0 for c in self._kept()])
        return found.filter(moved).select(_spelled(self.key).alias(_KEY), *[col(k).alias(n) for k, n in self.key.items()], *[col(c) for c in self._kept()])

    def _kept(self) -> list[str]:
        return [_ROWS, *self.sums, *[_FILLED.format(n) for n in self.sums]]

    def _next(self, delta: DataFrame, old: DataFrame | None, until: int) -> DataFrame:
        if old is None:
            return delta
        had = old.select(_KEY, *[col(c).alias(f"__had_{c}") for c in self._kept()])
        both = delta.join(had, _KEY, "left")
        return both.select(
            _KEY, *[col(n) for n in self.key.values()],
            *[(col(c) + F.coalesce(col(f"__had_{c}"), F.lit(0))).cast(delta.schema[c].dataType).alias(c) for c in self._kept()],
        )

    def _anew(self, delta: DataFrame, old: DataFrame, until: int) -> DataFrame:
        gone = old.join(delta.select(_KEY), _KEY, "left_anti")
        return delta.unionByName(gone.withColumns({c: F.lit(0).cast(delta.schema[c].dataType) for c in self._kept()}))

    def read(self) -> DataFrame | None:
        kept = self.state.read()
        if kept is None:
            return None
        return kept.filter(F.col(_ROWS) > 0).select(
            *[col(n) for n in self.key.values()], F.col(_ROWS).alias(self.count),
            *[F.when(col(_FILLED.format(n)) > 0, col(n)).alias(n) for n in self.sums],
        )


class KeyMart(_Following):
    """A mart of any kind with one row per key, computed anew for the keys of which a row came, changed or went.

    ``compute`` gives the mart of some rows of silver and has to depend on the rows of a key alone, such as the latest rates of a
    currency pair. Keys that lost all rows are not shown.
    """

    def __init__(self, source: BucketTable, state: BucketTable, key: list[str] | Mapping[str, str], compute: Callable[[DataFrame], DataFrame]):
        super().__init__(source, state, key)
        self.compute = compute

    def _delta(self, signed: DataFrame) -> DataFrame:
        """The touched keys: rows that are the same in both versions cancel out first."""
        columns = [c for c in signed.columns if c != _SIGN]
        moved = signed.groupBy(*[col(c) for c in columns]).agg(F.sum(_SIGN).alias(_SIGN)).filter(F.col(_SIGN) != 0)
        return moved.select(_spelled(self.key).alias(_KEY)).distinct()

    def _next(self, delta: DataFrame, old: DataFrame | None, until: int) -> DataFrame:
        rows = self.source.read(until).withColumn(_KEY, _spelled(self.key)).join(delta, _KEY, "left_semi").drop(_KEY)
        names = {n: n for n in self.key.values()}
        made = materialize(self.compute(rows).select(_spelled(names).alias(_KEY), F.lit(1).cast("long").alias(_ROWS), "*"), "made")
        gone = delta.join(made.select(_KEY), _KEY, "left_anti").withColumn(_ROWS, F.lit(0).cast("long"))
        return made.unionByName(gone, allowMissingColumns=True)

    def _anew(self, delta: DataFrame, old: DataFrame, until: int) -> DataFrame:
        return self._next(delta.union(old.select(_KEY)).distinct(), old, until)
