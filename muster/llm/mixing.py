"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

Targets: the sources, in code point order with NULL last, take the weights in turn and share a multiple of all words;
a target stops at ``limit`` times its source's words, and what is over is shared again by weight until none is above.
That is one level of water: ``min(limit * words, level * weight)``, found by running sums over the sources.

Each document's copies are target over words, whole copies plus a fraction. Fractions are rounded in pairs: words
move from one document's fraction to the other's, in a random direction that keeps every expectation, until one of
the two is whole. So each pair keeps its sum of words exactly. Small groups of documents are folded this way, each
leaves one fraction, and the residuals of a fixed number of groups meet in the next level of a reduction tree.

The last fold of a source has what the tree left open, and a bounded reserve that did not go through it: short documents,
or all of a source that has no more. There a document's partner is the whole reserve, so a long one is rounded first
and its words are made up by many short ones. Where they cannot make up for one choice (a document with more words than are
left to give), the other is made, and its expectation gives way to the target. The shortest few of the reserve are chosen
together, as those whose words come nearest to what is left. So a source misses its target by about as little as sums
of its documents allow. All draws are hashes: reruns agree.

Defined cases: NULL or blank texts have size 0 and are taken once when a copy is due anyway (0 words); a NULL source
is a source of its own; rows that repeat a doc_id and text are numbered and drawn on their own. Other columns are
passed through by ``mix`` and ignored by ``draws``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import KEYS, key_columns, packed, unpacked
from muster.plans.staging import Staging

# The weights the sources take in turn.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
#: Documents, or residuals, that one fold takes in on average.
GROUP = 64
#: Documents of a source that wait for its last fold: all of a source that has no more, else short ones, on average at most.
RESERVE = 512
#: Of these the shortest, whose best choice among all is taken in the end.
TAIL = 12


def n_words(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """source, source_size and target from (source, source_size); one row per source, in one task."""
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    cap, every = F.col("source_size") * limit, Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    level = (F.lit(share) * F.sum("source_size").over(every) - before) / rest
    levels = weighed.withColumn("level", level).withColumn("place", F.row_number().over(by_cap))
    # The first source, by how soon it fills, that the level of those from it on does not fill.
    open_ = F.when(F.col("level") * F.col("weight") <= cap, F.struct("place", "level"))
    levels = levels.withColumn("water", F.min(open_).over(every).getField("level"))
    target = F.least(cap.cast("double"), F.coalesce(F.col("water") * F.col("weight"), cap.cast("double")))
    return levels.select("source", "source_size", target.alias("target"))


#: Pairs the held fraction ``s.held`` with the next one ``x``. ``up`` words can move from x to the held document,
#: ``down`` the other way; up is drawn with probability down / (up + down), which keeps both expectations.
_UP = "least(s.held.size * (1 - s.held.f), x.size * x.f)"
_DOWN = "least(s.held.size * s.held.f, x.size * (1 - x.f))"
_DRAW = "(shiftrightunsigned(xxhash64({seed}L, s.held.id, x.id), 11) / 9007199254740992D)"
_ITEM = "'size', {0}.size, 'id', {0}.id, 'doc', {0}.doc, 'f', {1}"


def _item(which: str, f: str) -> str:
    return f"named_struct({_ITEM.format(which, f)})"


def _decide(which: str, take: int, held: str) -> str:
    done = f"array_append(s.done, named_struct('size', {which}.size, 'id', {which}.id, 'doc', {which}.doc, 'take', {take}))"
    return f"named_struct('held', {held}, 'done', {done})"


def _fold(items: str, seed: int, item_type: str, done_type: str) -> str:
    draw = _DRAW.format(seed=seed)
    lift = (
        f"CASE WHEN s.held.size * (1 - s.held.f) <= x.size * x.f "
        f"THEN {_decide('s.held', 1, _item('x', f'x.f - {_UP} / x.size'))} "
        f"ELSE {_decide('x', 0, _item('s.held', f's.held.f + {_UP} / s.held.size'))} END"
    )
    sink = (
        f"CASE WHEN s.held.size * s.held.f <= x.size * (1 - x.f) "
        f"THEN {_decide('s.held', 0, _item('x', f'x.f + {_DOWN} / x.size'))} "
        f"ELSE {_decide('x', 1, _item('s.held', f's.held.f - {_DOWN} / s.held.size'))} END"
    )
    start = f"CAST(named_struct('held', NULL, 'done', array()) AS STRUCT<held: {item_type}, done: ARRAY<{done_type}>>)"
    merge = (
        f"CASE WHEN s.held IS NULL THEN named_struct('held', x, 'done', s.done) "
        f"WHEN {draw} * ({_UP} + {_DOWN}) < {_DOWN} THEN {lift} ELSE {sink} END"
    )
    return f"aggregate({items}, {start}, (s, x) -> {merge})"


_CHANCE = "(shiftrightunsigned(xxhash64({seed}L, x.id), 11) / 9007199254740992D)"


def _settle(up: str, down: str, lacks: str, exceeds: str, share: str, draw: str) -> str:
    """Take a document (1) or not (0): by its share where the pool can balance either, else what it can balance, else
    what leaves the smaller miss."""
    return f"CASE WHEN {up} AND {down} THEN int({draw} < {share}) WHEN {up} THEN 1 WHEN {down} THEN 0 ELSE int({lacks} <= {exceeds}) END"


def _noted(take: str) -> str:
    return f"array_append(s.done, named_struct('size', x.size, 'id', x.id, 'doc', x.doc, 'take', {take}))"


def _pool_fold(seed: int, done_type: str, tail: int) -> str:
    """The last fold of a source, over ``open`` (what the tree left open) and ``pool`` (its reserve, of one fraction), both from
    long to short. ``w`` are the words that the pool still has to give, ``r`` its size.

    A document is rounded against the whole pool: taken, the pool gives its missing words; left, the pool gets its own. Then
    the pool's documents are rounded in turn against those that are left, and of the last ones the choice is made whose
    words come nearest to what is left."""
    draw = _CHANCE.format(seed=seed)
    words = "aggregate(pool, 0D, (a, x) -> a + x.size * x.f)"
    size = "aggregate(pool, 0D, (a, x) -> a + x.size)"
    start = f"CAST(named_struct('w', {words}, 'r', {size}, 'done', array()) AS STRUCT<w: double, r: double, done: ARRAY<{done_type}>>)"
    take = _settle("s.w >= x.size * (1 - x.f)", "s.w + x.size * x.f <= s.r", "x.size * (1 - x.f) - s.w", "s.w + x.size * x.f - s.r", "x.f", draw)
    first = f"aggregate(open, {start}, (s, x) -> named_struct('w', s.w + x.size * (x.f - {take}), 'r', s.r, 'done', {_noted(take)}))"
    take = _settle("s.w >= x.size", "s.w <= s.r - x.size", "x.size - s.w", "s.w - (s.r - x.size)", "s.w / s.r", draw)
    body = f"slice(pool, 1, greatest(size(pool) - {tail}, 0))"
    return f"aggregate({body}, {first}, (s, x) -> named_struct('w', s.w - x.size * {take}, 'r', s.r - x.size, 'done', {_noted(take)}))"


def _best_tail(seed: int) -> str:
    """Which documents of ``rest`` to take, as bits: the choice whose words come nearest to ``s.w``; a hash breaks ties."""
    words = "aggregate(transform(rest, (x, i) -> if(getbit(m, i) = 1, x.size, 0D)), 0D, (a, b) -> a + b)"
    choice = f"named_struct('miss', round(abs(s.w - {words}), 6), 'tie', xxhash64({seed}L, m, s.w), 'm', m)"
    return f"array_min(transform(sequence(0L, shiftleft(1L, size(rest)) - 1L), m -> {choice})).m"


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, k1, k2 and ``nth`` among rows that repeat a doc_id and text."""
    rows = docs.select("doc_id", "source", n_words().alias("size"), *key_columns())
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*KEYS).orderBy("source")))


def draws(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: int = 1, group: int = GROUP, reserve: int = RESERVE) -> DataFrame:
    """doc_id, k1, k2, nth, size, source, source_size, target and ``copies`` of every row."""
    staging = Staging(docs.sparkSession)
    rows = staging.keep(numbered(docs), "rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = staging.keep(targets(sizes, weights, share, limit), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    known = rows.join(
        goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of").withColumns({"whole": F.floor(rate).cast("int"), "f": rate - F.floor(rate)})
    # Sizes of nothing and rates without a fraction have nothing to round.
    open_ = (F.col("f") > 1e-12) & (F.col("size") > 0)

    doc = F.struct("doc_id", *KEYS, "nth", "source", "source_size", "target", "whole")
    items = known.where(open_).select(
        "source", F.struct(F.col("size").cast("double").alias("size"), F.xxhash64(*KEYS, "nth").alias("id"), doc.alias("doc"), "f").alias("item")
    )
    counts = items.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.avg("item.size").alias("mean"))
    counts = staging.keep(counts.withColumnRenamed("source", "of"), "counts")
    placed = items.join(counts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(-seed), "item.id"), 11) / F.lit(float(1 << 53))
    short = (F.col("n") <= reserve) | ((F.col("item.size") <= F.col("mean")) & (chance * F.col("n") < reserve))
    leaf = F.pmod(F.xxhash64(F.lit(seed), "item.id"), F.ceil(F.col("n") / group))
    placed = placed.select("source", leaf.alias("node"), "item", short.alias("short"))
    nodes, pool = placed.where("NOT short").drop("short"), placed.where("short").select("source", "item")
    item_type = items.schema["item"].dataType.simpleString()
    done_type = item_type[: item_type.rindex(",f:")] + ",take:int>"
    most = counts.where(F.col("n") > reserve).agg(F.max("n")).first()[0] or 0
    decided, level, widest = [], 0, -(-most // group)
    while widest > 1:
        gathered = nodes.groupBy("source", "node").agg(F.reverse(F.array_sort(F.collect_list("item"))).alias("items"))
        folded = gathered.select("source", "node", F.expr(_fold("items", seed + level, item_type, done_type)).alias("s"))
        folded = staging.keep(folded, f"level{level}")
        decided.append(folded.select(F.explode("s.done").alias("d")))
        nodes = folded.select("source", F.floor(F.col("node") / group).alias("node"), F.col("s.held").alias("item"))
        widest, level = -(-widest // group), level + 1
    # The last fold of each source: what is open, at most GROUP documents, against the reserve.
    both = nodes.select("source", F.lit(True).alias("held"), "item").unionByName(pool.select("source", F.lit(False).alias("held"), "item"))
    last = both.groupBy("source").agg(
        *[F.reverse(F.array_sort(F.collect_list(F.when(rule, F.col("item"))))).alias(n) for n, rule in (("open", F.col("held")), ("pool", ~F.col("held")))]
    )
    last = staging.keep(last.select("pool", F.expr(_pool_fold(seed + level, done_type, TAIL)).alias("s")), "last")
    rest = last.select("s", F.expr(f"slice(pool, greatest(size(pool) - {TAIL}, 0) + 1, {TAIL})").alias("rest"))
    rest = rest.withColumn("m", F.expr(_best_tail(seed + level)))
    chosen = F.expr("transform(rest, (x, i) -> named_struct('size', x.size, 'id', x.id, 'doc', x.doc, 'take', cast(getbit(m, i) AS int)))")
    done = rest.select(F.explode(F.concat(chosen.cast(f"array<{done_type}>"), "s.done")).alias("d"))
    for more in decided:
        done = done.unionByName(more)
    rounded = done.select(
        "d.doc.doc_id", "d.doc.k1", "d.doc.k2", "d.doc.nth", "d.doc.source", F.col("d.size").cast("long").alias("size"),
        "d.doc.source_size", "d.doc.target", (F.col("d.doc.whole") + F.col("d.take")).alias("copies"),
    )
    taken = known.where(~open_).select(
        "doc_id", *KEYS, "nth", "source", "size", "source_size", "target", F.col("whole").alias("copies")
    )
    return taken.unionByName(rounded)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in the mix, as often as each is drawn, with all their columns."""
    counts = draws(docs, **options).select(*KEYS, "nth", "copies").where("copies > 0")
    same = Window.partitionBy(*KEYS).orderBy("row.source")
    rows = packed(docs).withColumn("nth", F.row_number().over(same))
    times = rows.join(counts, [*KEYS, "nth"])
    return unpacked(times.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")))
