"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same fractional number of copies; its fraction is rounded so
that the source's words come out at the target. Fractions of a bucket of documents are paired one
after the other: words move from one to the other, in a random direction that keeps both
expectations, until one is whole. A bucket leaves one unfinished document; these meet in buckets
of the next level, up to one per source. All expressions are Spark's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_names, written

WORD = r"[^\x20\x09-\x0D]+"
FAN_IN = 64
SEED = 20_240
#: Equal rows are numbered in slices of two to this power of rows.
RUN_BITS = 12

_ITEM = "struct<o:bigint,key:bigint,row:bigint,id:{id},source:string,size:bigint,base:bigint,mass:double,u:double,spare:double>"
#: One pairing: cur and x stand for the fractions a of A and b of B words; up to `up` words can move
#: from x to cur and up to `down` the other way, and the directions' odds keep the expectations.
_PAIR = """
aggregate(items, named_struct('cur', cast(null as {item}), 'done', cast(array() as array<{item}>)), (acc, x) ->
  if(acc.cur is null, named_struct('cur', x, 'done', acc.done),
    element_at(transform(array(named_struct('up', least(acc.cur.size - acc.cur.mass, x.mass), 'down', least(acc.cur.mass, x.size - x.mass))), t ->
      case
        when x.u * (t.up + t.down) < t.down and acc.cur.size - acc.cur.mass <= x.mass then
          named_struct('cur', {x_up}, 'done', concat(acc.done, array({cur_full})))
        when x.u * (t.up + t.down) < t.down then
          named_struct('cur', {cur_up}, 'done', concat(acc.done, array({x_none})))
        when acc.cur.mass <= x.size - x.mass then
          named_struct('cur', {x_down}, 'done', concat(acc.done, array({cur_none})))
        else
          named_struct('cur', {cur_down}, 'done', concat(acc.done, array({x_full})))
      end), 1)))
"""


def _with_mass(item: str, mass: str) -> str:
    fields = ("o", "key", "row", "id", "source", "size", "base")
    return "named_struct(" + ", ".join(f"'{f}', {item}.{f}" for f in fields) + f", 'mass', cast({mass} as double), 'u', {item}.u, 'spare', {item}.spare)"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): sources in code point order, a missing one
    last, share the total by repeating weights; none gets more than `most` times its size, and what is
    over is shared again by weight. One row a source, so the running sums are over a small table."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    table = sizes.withColumn("w", weight.cast("double")).withColumn("cap", most * F.col("source_size"))
    everything = Window.partitionBy()
    level = Window.orderBy(F.col("cap") / F.col("w"), "w", F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    rest = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    table = table.withColumn("rank", F.row_number().over(level)).withColumn("rate", rest)
    table = table.withColumn("rate", F.min_by("rate", F.when(F.col("rate") <= F.col("cap") / F.col("w"), F.col("rank"))).over(everything))
    return table.select("source", "source_size", F.least(F.col("cap"), F.col("rate") * F.col("w")).alias("target"))


def mixed_copies(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", fan_in: int = FAN_IN, seed: int = SEED) -> DataFrame:
    """(id, source, key, size, source_size, target, copies, taken) of every row; key is a hash of its content
    and of its number among equal rows.

    Size: words of the text, null or empty 0; such rows get no copies' worth of words (copies is the
    whole part of their source's). taken = copies * size, copies at most `most`. Draws come from
    the keys, so reruns agree; fully equal rows are drawn apart. An empty table gives no rows.
    """
    (row,) = free_names(docs, "mix_row")
    return _drawn(docs.withColumn(row, F.monotonically_increasing_id()), row, weights, most, text_col, source_col, id_col, fan_in, seed).drop(row)


def numbered_keys(rows: DataFrame) -> DataFrame:
    """rows (row, key, ..) with each key once: equal keys are numbered and hashed with their number, except
    the first. Numbers run within slices of rows, then over slices, so equal rows meet in no task."""
    slices = rows.withColumn("slice", F.shiftright("row", RUN_BITS))
    counts = slices.groupBy(F.col("key").alias("of_key"), F.col("slice").alias("of_slice")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("of_key").orderBy("of_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.sum("n").over(before)).where("offset > 0").drop("n")
    local = F.row_number().over(Window.partitionBy("key", "slice").orderBy("row")) - 1
    joined = slices.withColumn("local", local).join(offsets, (F.col("key") == F.col("of_key")) & (F.col("slice") == F.col("of_slice")), "left")
    number = F.col("local") + F.coalesce("offset", F.lit(0))
    return joined.withColumn("key", F.when(number == 0, F.col("key")).otherwise(F.xxhash64("key", number))).select(*rows.columns)


def _drawn(docs: DataFrame, row: str, weights: tuple[int, ...], most: int, text_col: str, source_col: str, id_col: str, fan_in: int, seed: int) -> DataFrame:
    """mixed_copies with each row's number, the docs' column `row`."""
    text = F.col(text_col).cast("string")
    chosen = docs.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(id_col, source_col, text).alias("key"))
    sizes = written(chosen, "mix-sizes")
    rows = numbered_keys(sizes)
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("n"))
    targets = source_targets(per_source.select("source", "source_size"), weights, float(most))
    n = per_source.select(F.col("source").alias("n_source"), "n")
    table = written(targets.join(n, F.col("source").eqNullSafe(F.col("n_source"))).select(F.col("source").alias("of"), "source_size", "target", "n"), "mix-targets")
    largest = table.agg(F.max("n")).first()[0] or 0

    joined = rows.join(table, F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", rate).withColumn("base", F.floor("rate")).withColumn("mass", (F.col("rate") - F.col("base")) * F.col("size"))
    item = _ITEM.format(id=rows.schema["id"].dataType.simpleString())
    uniform = lambda *of: F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(1 << 40)) / F.lit(float(1 << 40))
    split = (F.col("size") > 0) & (F.col("mass") > 0)
    finished = [joined.where(~split).select("row", "id", "source", "key", "size", "base", F.lit(0).alias("extra"))]

    buckets = F.greatest(F.lit(1), F.ceil(F.col("n") / fan_in)).cast("long")
    struct = F.struct(F.xxhash64(F.lit(seed), F.lit("order"), "key").alias("o"), "key", "row", "id", "source", "size", "base", "mass", uniform(F.lit("pair 0"), "key").alias("u"), uniform(F.lit("last"), "key").alias("spare")).cast(item)
    level = joined.where(split).select(F.pmod(F.xxhash64(F.lit(seed), F.lit("bucket 0"), "key", "id"), buckets).alias("bucket"), buckets.alias("buckets"), struct.alias("item"))
    count, depth = -(-largest // fan_in), 0
    pair = _PAIR.format(item=item, cur_full=_with_mass("acc.cur", "acc.cur.size"), cur_none=_with_mass("acc.cur", "0"), x_full=_with_mass("x", "x.size"), x_none=_with_mass("x", "0"), x_up=_with_mass("x", "x.mass - t.up"), cur_up=_with_mass("acc.cur", "acc.cur.mass + t.up"), x_down=_with_mass("x", "x.mass + t.down"), cur_down=_with_mass("acc.cur", "acc.cur.mass - t.down"))
    while True:
        grouped = level.groupBy(F.col("item.source").alias("source"), "bucket", "buckets").agg(F.array_sort(F.collect_list("item")).alias("items"))
        paired = written(grouped.select("bucket", "buckets", F.expr(pair).alias("r")).select("bucket", "buckets", "r.cur", "r.done"), "mix-level")
        done = paired.select(F.explode("done").alias("item"))
        finished.append(done.select("item.row", "item.id", "item.source", "item.key", "item.size", "item.base", (F.col("item.mass") > 0).cast("int").alias("extra")))
        if count <= 1:
            cur = paired.select(F.col("cur").alias("item"))
            finished.append(cur.select("item.row", "item.id", "item.source", "item.key", "item.size", "item.base", (F.col("item.spare") * F.col("item.size") < F.col("item.mass")).cast("int").alias("extra")))
            break
        depth += 1
        up = F.col("cur")
        item_up = up.withField("u", uniform(F.lit(f"pair {depth}"), F.col("cur.key")))
        fewer = F.greatest(F.lit(1), F.ceil(F.col("buckets") / fan_in)).cast("long")
        level = paired.select(F.floor(F.col("bucket") / fan_in).alias("bucket"), fewer.alias("buckets"), item_up.alias("item"))
        count = -(-count // fan_in)
    union = finished[0]
    for part in finished[1:]:
        union = union.unionByName(part)
    copies = (F.col("base") + F.col("extra")).cast("int")
    return union.join(table.select("of", "source_size", "target"), F.col("source").eqNullSafe(F.col("of"))).select(F.col("row").alias(row), F.col("id").alias(id_col), "source", "key", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights: tuple[int, ...] = (1, 2, 3), most: int = 3, fan_in: int = FAN_IN, seed: int = SEED) -> DataFrame:
    """The mix itself: every row as often as it was drawn, with all its columns. Rows without words stay once:
    they take nothing of the mix. Fully equal rows each get one of their draws: rows are numbered in a
    table and meet their draws by that number, so no group of equal rows meets."""
    row, of, n = free_names(docs, "mix_row", "mix_of", "mix_copies")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    drawn = _drawn(rows, row, weights, most, text_col, source_col, id_col, fan_in, seed)
    drawn = drawn.select(F.col(row).alias(of), F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias(n)).where(F.col(n) > 0)
    return rows.join(drawn, F.col(row) == F.col(of)).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(n))).alias(row)).drop(row)
