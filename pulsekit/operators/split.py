"""Patient-isolated train / validation / test split.

Distinct ids are ordered by sha256(seed || ':' || id) -- a seeded shuffle that
is identical on task retry and independent of partitioning -- and ranked with
a running count over hash ranges, so no single task sees all ids. Exact split
sizes follow from the id count: n_train = floor(n*r_train),
n_val = floor(n*r_val), the rest is test. If validation (then test) comes out
empty while train holds more than one id, the highest-ranked train id moves
over. Every split is a run of hashes, so a row finds its own by comparing its id's
hash with the runs' ends (J1); splits cannot overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.operators.ordered import ranged, running_totals


def split_sizes(n: int, ratios: tuple[float, float, float] = (0.70, 0.15, 0.15)) -> dict[str, int]:
    """Exact sizes and rescue moves, as plain integers (driver arithmetic on one number)."""
    r_train, r_val, r_test = ratios
    if abs(r_train + r_val + r_test - 1.0) >= 1e-5:
        raise ValueError(f"split ratios add up to {sum(ratios)}, not 1")
    n_train = int(n * r_train)
    n_val = int(n * r_val)
    n_test = n - n_train - n_val
    to_val = 1 if (n_val == 0 and n_train > 1) else 0
    n_train -= to_val
    to_test = 1 if (n_test == 0 and n_train > 1) else 0
    n_train -= to_test
    return {"n": n, "train": n_train, "val": n_val + to_val, "test": n_test + to_test,
            "to_val": to_val, "to_test": to_test, "base_train": n_train + to_val + to_test, "base_val": n_val}


def _position(id_col: str, seed: int):
    """An id's place in the seeded order: a hash, so that ids need no random numbers."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def rank_ids(df: DataFrame, id_col: str = "patient_id", seed: int = 42, n_ranges: int | None = None) -> DataFrame:
    """(id, rank) for every distinct non-NULL id in seeded-hash order, rank 1-based."""
    return _ranked(df, id_col, seed, n_ranges).select(id_col, F.col("cum___one").alias("rank"))


def _ranked(df: DataFrame, id_col: str, seed: int, n_ranges: int | None) -> DataFrame:
    ids = df.select(F.col(id_col).cast("string").alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
    keyed = ids.select(id_col, _position(id_col, seed).alias("__h"), F.lit(1).cast("bigint").alias("__one"))
    return running_totals(ranged(keyed, [], ["__h"], n_ranges), [], ["__h"], ["__one"])


def _segments(n: int, ratios: tuple[float, float, float]) -> list[tuple[int, str]]:
    """(last rank, split) of the consecutive runs of ranks, empty ones left out."""
    s = split_sizes(n, ratios)
    ends, last = [], 0
    for size, name in ((s["base_train"] - s["to_val"] - s["to_test"], "train"), (s["to_test"], "test"),
                       (s["to_val"], "val"), (s["base_val"], "val"),
                       (n - s["base_train"] - s["base_val"], "test")):
        last += size
        if size:
            ends.append((last, name))
    return ends


def _by_bound(value, bounds: list[tuple]):
    """The split whose upper bound is the first not below ``value``; the last bound is open."""
    out = F.lit(bounds[-1][1])
    for bound, name in reversed(bounds[:-1]):
        out = F.when(value <= F.lit(bound), F.lit(name)).otherwise(out)
    return out


def assign_splits(
    df: DataFrame,
    id_col: str = "patient_id",
    ratios: tuple[float, float, float] = (0.70, 0.15, 0.15),
    seed: int = 42,
    n_ranges: int | None = None,
) -> DataFrame:
    """(id, rank, split) per distinct id."""
    if id_col not in df.columns:
        raise ValueError(f"The split needs the id column '{id_col}'.")
    ranks = _ranked(df, id_col, seed, n_ranges)
    total = ranks.select("total___one").first()
    ends = _segments(total[0] if total else 0, ratios) or [(0, "test")]
    return ranks.select(id_col, F.col("cum___one").alias("rank")).withColumn("split", _by_bound(F.col("rank"), ends))


def split_by_patient(
    df: DataFrame,
    id_col: str = "patient_id",
    ratios: tuple[float, float, float] = (0.70, 0.15, 0.15),
    seed: int = 42,
) -> DataFrame:
    """Rows with a ``split`` column (J1); rows with a NULL id get no split and are dropped.

    Every split is a run of consecutive hashes, so the ids are ranked once, the
    hashes at the ends of the runs (at most four) become literals, and each row
    is placed by its own hash: no join and no shuffle of the rows.
    """
    if id_col not in df.columns:
        raise ValueError(f"The split needs the id column '{id_col}'.")
    ranks = _ranked(df, id_col, seed, None)
    total = ranks.select("total___one").first()
    ends = dict(_segments(total[0] if total else 0, ratios))
    found = {r.rank: r.hash for r in ranks.where(F.col("cum___one").isin(list(ends))).select(
        F.col("cum___one").alias("rank"), F.col("__h").alias("hash")).collect()}
    bounds = [(found[rank], name) for rank, name in ends.items()] or [("", "test")]
    return df.where(F.col(id_col).isNotNull()).withColumn("split", _by_bound(_position(id_col, seed), bounds))


def splits(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    tagged = split_by_patient(df, **kw)
    return tuple(tagged.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test"))
