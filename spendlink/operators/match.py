"""Blocked best-match join: for each distinct item text, the best ``k`` candidate texts of its block.

The join never lists the pairs of a block. Both sides' distinct texts are dealt to *meetings* of bounded size:

1. distinct texts per block (partial aggregation removes repeated descriptions before the shuffle). With ``k = 1`` an
   item text that is also a candidate text is settled here by an equi-join on the partitioning both sides already have:
   no other text can round to 100;
2. a small directory per block: number, shortest and longest length of the texts of each length band, on both sides.
   Blocks that exist on one side only stop here;
3. each side of a block is cut into tiles of bounded size, by length band and text hash, so a block with a third of
   all rows is many tiles like any other. A meeting is one item tile with one candidate tile; a text goes to the
   meetings whose other tile has lengths that can still reach the cutoff (``2 * short / (short + long)``);
4. one Arrow UDF ranks each meeting and returns at most ``k`` hits per item; a window merges them over meetings.

The copies of a text in step 3 grow with the other side of its block. From cutoffs of about 90 on, rare grams bound them (see
``functions.grams``): where a block's texts would have fewer cells than meetings, each text goes to one cell per rare gram,
and items and candidates of a cell meet as those of a block do, tiles and all. Only texts too short for a bound still meet
by length. The counts that say which grams are rare are those of the ``COMMON`` most frequent ones, a fixed number.

Ties go to the smallest candidate id. Only the one-row directory of an unblocked match is broadcast; elsewhere Spark decides
from measured sizes.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlink.functions.grams import Grams, all_tokens, gram_plan, rare_cells
from spendlink.functions.normalize import fast_form, fuzzy_form
from spendlink.functions.tiles import best_in_tile
from spendlink.sources.shared import materialize

# Texts per tile. A text longer than LONG characters counts for several, which bounds bytes and work per meeting too.
ITEM_TILE = 1024
CANDIDATE_TILE = 2048
LONG = 256
BANDS_PER_OCTAVE = 4
# Frequent grams whose counts every task gets.
COMMON = 1 << 16


@dataclass(frozen=True)
class Scorer:
    """How the two sides are normalised and to how many digits the score is rounded."""

    item_form: Callable[[Column], Column]
    candidate_form: Callable[[Column], Column]
    digits: int
    stored_form: bool


# FUZZY normalises both sides; FAST_FUZZY takes the candidate's stored, already normalised text as it is.
SCORERS = {
    "FUZZY": Scorer(fuzzy_form, fuzzy_form, 0, stored_form=False),
    "FAST_FUZZY": Scorer(fast_form, lambda c: c, 2, stored_form=True),
}


# Tile groups of one side of a block: one group if a single tile holds the side, else one group per length band.
GROUPS = """
    if({side}_load <= {tile_size},
       array(named_struct('band', -1, 'tiles', 1L, 'lo', {side}_lo, 'hi', {side}_hi)),
       transform(filter(bands, e -> e.{side}_n > 0),
                 e -> named_struct('band', e.band, 'tiles', ceil(e.{side}_load / {tile_size}),
                                   'lo', e.{side}_lo, 'hi', e.{side}_hi))) AS {side}_groups
"""

# The text's own tile, and every tile of the other side whose lengths can still reach the cutoff.
OWN_TILE = """
    named_struct('band', if(own[0].band = -1, -1, band),
                 'tile', pmod(xxhash64(text),
                              if(own[0].band = -1, 1L, filter(own, g -> g.band = band)[0].tiles))) AS own_tile
"""
OTHER_TILES = """
    explode(flatten(transform(
        filter(other, g -> {slack} + coalesce(try_divide(200D * least(len, g.hi),
                                                         len + greatest(least(len, g.hi), g.lo)), 100D) >= {cutoff}),
        g -> transform(sequence(0L, g.tiles - 1), t -> named_struct('band', g.band, 'tile', t))))) AS other_tile
"""


def _smallest_ids(candidates: DataFrame, keys: list[str], k: int) -> DataFrame:
    """At most ``k`` ids per block and text. Equal texts score alike, so later ids can never be among the best k."""
    if k == 1:
        return candidates.groupBy(*keys).agg(F.min("cand_id").alias("cand_id"))
    order = Window.partitionBy(*keys).orderBy("cand_id")
    return candidates.withColumn("nth", F.row_number().over(order)).filter(f"nth <= {k}").drop("nth")


def _directory(texts: DataFrame, keys: list[str], item_tile: int, candidate_tile: int, plan: Grams | None = None) -> DataFrame:
    """Tile groups of both sides per block. A block has four bands per doubling of length, whatever its size.

    ``by_grams`` tells blocks whose texts would have fewer cells than meetings.
    """
    sides = {"item": item_tile, "cand": candidate_tile}
    # Counting candidates by id keeps the column in this branch, so both uses of the distinct texts share one shuffle.
    counted = {"item": "count(text)", "cand": "count(cand_id)"}
    per_band = [
        F.expr(f"{function} filter (where side = '{side}') AS {side}_{name}")
        for side in sides
        for name, function in (
            ("n", counted[side]), ("lo", "min(len)"), ("hi", "max(len)"), ("load", f"sum(greatest(1D, len / {LONG}))")
        )
    ]
    per_block = [
        F.expr(f"{function}({side}_{name}) AS {side}_{column}")
        for side in sides
        for function, name, column in (("sum", "n", "total"), ("min", "lo", "lo"), ("max", "hi", "hi"), ("sum", "load", "load"))
    ]
    cells = "0L" if plan is None else f"sum({plan.cells_sql('len')})"
    meetings = f"item_total * ceil(cand_load / {candidate_tile}) + cand_total * ceil(item_load / {item_tile})"
    entry = "struct(" + ", ".join(["band", *(f"{s}_{m}" for s in sides for m in ("n", "lo", "hi", "load"))]) + ")"
    return (
        texts.groupBy(*keys, "band")
        .agg(*per_band, F.expr(f"{cells} AS cells"))
        .groupBy(*keys)
        .agg(F.expr(f"collect_list({entry}) AS bands"), F.sum("cells").alias("cells"), *per_block)
        .filter("item_total > 0 and cand_total > 0")
        .selectExpr(
            *keys, *(GROUPS.format(side=side, tile_size=size) for side, size in sides.items()),
            "false AS by_grams" if plan is None else f"cells < {meetings} AS by_grams",
        )
    )


def _meetings(texts: DataFrame, directory: DataFrame, keys: list[str], slack: float, cutoff: float) -> DataFrame:
    """Each text once per meeting: its own tile with every tile of the other side it could match."""
    return (
        texts.join(directory, keys)
        .selectExpr(
            *keys,
            "text", "cand_id", "side", "band", "len",
            "if(side = 'item', item_groups, cand_groups) AS own",
            "if(side = 'item', cand_groups, item_groups) AS other",
        )
        .selectExpr(*keys, "text", "cand_id", "side", OWN_TILE, OTHER_TILES.format(slack=slack, cutoff=cutoff))
        .selectExpr(
            *keys,
            "if(side = 'item', own_tile, other_tile) AS item_tile",
            "if(side = 'item', other_tile, own_tile) AS cand_tile",
            "if(side = 'item', text, null) AS item",
            "if(side = 'cand', struct(cand_id, text), null) AS cand",
        )
    )


def _in_cells(texts: DataFrame, plan: Grams) -> DataFrame:
    """Each text once per cell."""
    tokens = texts.select(F.explode(all_tokens(F.col("text"), plan)).alias("token"))
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    common = [tuple(r) for r in counted.orderBy(F.desc("n"), "token").limit(COMMON).collect()]
    return texts.withColumn("cell", F.explode(rare_cells(F.col("text"), plan, common)))


def _hits(met: DataFrame, keys: list[str], digits: int, cutoff: float, k: int) -> DataFrame:
    """The best ``k`` hits of each item text in each meeting."""
    meeting = [*keys, "item_tile", "cand_tile"]
    # Few rows, much work per row: a fixed partition count keeps small shuffles from being merged into one task.
    partitions = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = (
        met.repartition(partitions, *meeting)
        .groupBy(*meeting)
        .agg(F.expr("collect_list(item) AS texts"), F.expr("sort_array(collect_list(cand)) AS cands"))
        .filter("size(texts) > 0 and size(cands) > 0")
    )
    found = best_in_tile(F.col("texts"), F.col("cands.text"), digits, cutoff, k)
    return tiles.select(*keys, "texts", "cands", found.alias("hits")).selectExpr(
        *keys, "inline(transform(hits, h -> struct(texts[h.i] AS text, cands[h.j].cand_id AS cand_id, h.score AS score)))"
    )


def best_matches(
    items: DataFrame,
    candidates: DataFrame,
    *,
    cutoff: float,
    k: int = 1,
    digits: int = 0,
    block: list[str] | None = None,
    item_tile: int = ITEM_TILE,
    candidate_tile: int = CANDIDATE_TILE,
) -> DataFrame:
    """Best ``k`` candidates with a rounded score of at least ``cutoff`` for each distinct ``(block, text)``.

    ``items`` has the block columns and ``text``; ``candidates`` has them too, and ``cand_id``. Texts are compared as
    they are, null as blank; null blocks match nothing. Without block columns every text meets every tile of fitting
    length. Result: block columns, ``text``, ``cand_id``, ``score``, ``rank``.
    """
    keys = block or ["everything"]
    columns = [*block, "coalesce(text, '') AS text"] if block else ["0 AS everything", "coalesce(text, '') AS text"]
    left = items.selectExpr(*columns).dropna(subset=block or keys).distinct()
    right = _smallest_ids(candidates.selectExpr(*columns, "cand_id").dropna(subset=keys), [*keys, "text"], k)
    settled = None
    if k == 1:
        # 100 * (n - 1) / n rounds to less than 100 up to this combined length.
        short = f"2 * length(text) < {200 * 10**digits} AND equal_id IS NOT NULL"
        left = left.join(right.withColumnRenamed("cand_id", "equal_id"), [*keys, "text"], "left")
        settled = left.filter(short).selectExpr(*keys, "text", "equal_id AS cand_id", "100D AS score")
        left = left.filter(f"NOT ({short})").drop("equal_id")
    measured = ["text", "length(text) AS len", f"int(floor(log2(length(text) + 1) * {BANDS_PER_OCTAVE})) AS band"]
    texts = left.selectExpr(*keys, *measured, "'item' AS side").unionByName(
        right.selectExpr(*keys, *measured, "'cand' AS side", "cand_id"), allowMissingColumns=True
    )
    # Half a unit of the last digit covers the rounding of the score.
    slack = 0.5 / 10**digits + 1e-9
    plan = gram_plan(cutoff - slack)
    if plan:
        texts = materialize(texts, "match-texts")
    directory = _directory(texts, keys, item_tile, candidate_tile, plan)
    by_cell = None
    if plan:
        hot = directory.filter("by_grams").select(*keys)
        directory = directory.filter("NOT by_grams")
        if not hot.isEmpty():
            celled = materialize(_in_cells(texts.join(hot, keys), plan), "match-cells")
            inner = [*keys, "cell"]
            met = _meetings(celled, _directory(celled, inner, item_tile, candidate_tile), inner, slack, cutoff)
            # A pair may share several cells.
            by_cell = _hits(met, inner, digits, cutoff, k).drop("cell").distinct()
    if not block:
        directory = F.broadcast(directory)  # a single row
    hits = _hits(_meetings(texts, directory, keys, slack, cutoff), keys, digits, cutoff, k)
    if by_cell is not None:
        hits = hits.unionByName(by_cell)
    best = Window.partitionBy(*keys, "text").orderBy(F.desc("score"), "cand_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(f"rank <= {k}")
    if settled is not None:
        ranked = ranked.unionByName(settled.withColumn("rank", F.lit(1)))
    return ranked if block else ranked.drop("everything")
