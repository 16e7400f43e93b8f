"""Limit, seeded shuffle, exact train/eval split, batches and epochs.

Every order here is a hash of (seed, row_id): the same in any partitioning
and in any engine that has md5. Positions are exact (see ``ordinal``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.operators.ordinal import hash_first, hash_ordinal


def seed_key(*parts: Column | str | int) -> Column:
    """md5 of the parts joined with ``:``, e.g. md5("42:17")."""
    cols = [F.lit(str(p)) if isinstance(p, (int, str)) and not isinstance(p, bool) else p for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def limit_samples(df: DataFrame, n: int | None, row_id: str = "row_id") -> DataFrame:
    """First ``n`` rows in file order; ``None`` or ``n <= 0`` keeps all."""
    if n is None or n <= 0:
        return df
    return df.filter(F.col(row_id) <= F.lit(n))


def seeded_shuffle(df: DataFrame, seed: int = 42, row_id: str = "row_id", out: str = "position") -> DataFrame:
    """Seeded permutation, returned as a ``position`` 1..n column."""
    return hash_ordinal(df, seed_key(seed, F.col(row_id)), tie=[row_id], out=out)


def train_eval_split(
    df: DataFrame,
    fraction: float = 0.1,
    seed: int = 42,
    row_id: str = "row_id",
    out: str = "split",
) -> DataFrame:
    """Add ``split`` = ``eval`` for exactly ceil(fraction * n) rows, else ``train``.

    Fraction 0 (or less) keeps every row in ``train``. Either part empty
    fails the job, as a train/test split of the whole table would. The eval
    rows are the first ceil(fraction * n) by md5("split:seed:row_id"); n and
    the cut come from the hash-bucket histogram (``hash_first``), so only the
    bucket the cut falls in is shuffled.
    """
    if fraction <= 0:
        return df.withColumn(out, F.lit("train"))
    if fraction >= 1:
        raise ValueError("fraction must be below 1")
    f = float(fraction)

    def bad(n, k):
        msg = F.concat(F.lit(f"split by {fraction!r} leaves a part empty of rows: "), n.cast("string"))
        return F.when((k < 1) | (k >= n), F.raise_error(msg))

    marked = hash_first(df, seed_key("split", seed, F.col(row_id)), [row_id],
                        lambda n: F.ceil(F.lit(f) * n), out="_eval", check=bad)
    split = F.when(F.col("_eval"), F.lit("eval")).otherwise(F.lit("train"))
    return marked.withColumn(out, split).drop("_eval")


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))


ROUNDS = 6
MULTIPLIERS = (1_540_483_477, 1_103_515_245)  # odd, below 2**31
LOW31 = (1 << 31) - 1


SHAPES = 200_000


def permutation_shape(n: int) -> tuple[int, int, int]:
    """``(a, b, excess)``: sides a * b = n + excess, a between two thirds of the square root and that.

    The least excess among ``SHAPES`` sides at most. Sides below 2**31 keep all products within
    a bigint, so n may go up to 2**60.
    """
    root = max(1, math.isqrt(n))
    low = -(-2 * root // 3)
    sides = range(low, root + 1, max(1, (root - low) // SHAPES))
    best = min(sides, key=lambda a: (a * -(-n // a) - n, root - a))
    return best, max(1, -(-n // best)), best * -(-n // best) - n


def permuted_position(row_id: Column, n: int, *key: Column | int) -> Column:
    """Position 1..n of ``row_id`` (1..n) in the order that ``key`` (a seed, an epoch) stands for.

    A keyed permutation computed in place: ``row_id - 1`` is split into two digits, each of which
    is moved in turn by a keyed hash of the other (a Feistel network over mixed radices), which
    is one to one on a * b values. Values of n and above are sent through again; there are
    ``excess`` of them, so ``excess + 1`` times always suffice. No row needs to know another.
    """
    a, b, excess = permutation_shape(n)
    keys = [F.conv(F.substring(seed_key(*key, r), 1, 7), 16, 10).cast("long") for r in range(ROUNDS)]

    def mixed(digit: Column, k: Column) -> Column:
        x = (digit.bitwiseAND(F.lit(LOW31)) + k) % F.lit(LOW31) * F.lit(MULTIPLIERS[0])
        x = x.bitwiseXOR(F.shiftright(x, 15)).bitwiseAND(F.lit(LOW31)) * F.lit(MULTIPLIERS[1])
        return F.shiftright(x.bitwiseXOR(F.shiftright(x, 13)), 4).bitwiseAND(F.lit(LOW31))

    def turn(p: Column, k: Column) -> Column:
        """Move the first digit by the second, and swap them."""
        moved = (p["x"] + mixed(p["y"], k)) % p["m"]
        return F.struct(p["y"].alias("x"), moved.alias("y"), p["o"].alias("m"), p["m"].alias("o"))

    def once(v: Column) -> Column:
        side = lambda x: F.lit(x).cast("long")
        start = F.struct(F.call_function("div", v, side(b)).alias("x"), (v % side(b)).alias("y"), side(a).alias("m"), side(b).alias("o"))
        return F.aggregate(F.array(*keys), start, turn, lambda p: p["x"] * side(b) + p["y"])

    v = once(row_id.cast("long") - 1)
    if excess:
        v = F.aggregate(F.sequence(F.lit(1), F.lit(excess)), v, lambda x, _: F.when(x >= n, once(x)).otherwise(x))
    return v + 1


def assign_batches(
    df: DataFrame,
    batch_size: int = 2,
    grad_accum: int = 4,
    epochs: int = 1,
    max_steps: int = -1,
    seed: int = 42,
    row_id: str = "row_id",
    order: str = "hash",
) -> DataFrame:
    """Optimizer step of every row in every epoch.

    Each epoch has its own seeded order; ``batch_size * grad_accum`` rows make
    one step, the last step of an epoch may be short. Adds ``epoch``,
    ``epoch_pos``, ``step`` (global) and ``micro_batch``; ``max_steps > 0``
    keeps steps below it.

    ``order``: ``hash`` ranks rows by md5 of (seed, epoch, row id), whatever the ids are, and
    moves the rows once per epoch; ``permutation`` needs ids 1..n without gaps (as
    ``with_row_id`` makes them; anything else fails) and computes each position where the
    row lies (``permuted_position``): one count, and no row is moved.
    """
    if batch_size < 1 or grad_accum < 1 or epochs < 1:
        raise ValueError("batch_size, grad_accum and epochs must be positive")
    if order not in ("hash", "permutation"):
        raise ValueError("order must be hash or permutation")
    per_step = batch_size * grad_accum
    if order == "permutation":
        n, low, high, xor = df.agg(F.count(F.lit(1)), F.min(row_id), F.max(row_id), F.bit_xor(row_id)).first()
        if n and ((low, high) != (1, n) or xor != _xor_to(n)):
            raise ValueError(f"{row_id} must hold every number from 1 to {n} once")
        if max_steps > 0:
            epochs = min(epochs, -(-max_steps // max(1, -(-n // per_step))))
        rows = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        ranked = rows.withColumns({"epoch_pos": permuted_position(F.col(row_id), n, seed, F.col("epoch")), "_n": F.lit(n).cast("long")})
    else:
        rows = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        ranked = hash_ordinal(
            rows, seed_key(seed, F.col("epoch"), F.col(row_id)), tie=[row_id], out="epoch_pos",
            partition_by=["epoch"], total="_n",
        )
    steps_per_epoch = F.floor((F.col("_n") + F.lit(per_step - 1)) / F.lit(per_step)).cast("long")
    local = F.floor((F.col("epoch_pos") - 1) / per_step).cast("long")
    ranked = ranked.withColumn("step", F.col("epoch") * steps_per_epoch + local).withColumn(
        "micro_batch", F.floor(((F.col("epoch_pos") - 1) % per_step) / batch_size).cast("long")
    ).drop("_n")
    if max_steps > 0:
        ranked = ranked.filter(F.col("step") < max_steps)
    return ranked


def _xor_to(n: int) -> int:
    """1 ^ 2 ^ ... ^ n."""
    return (n, 1, n + 1, 0)[n % 4]
