"""Near-duplicate groups: one-permutation MinHash, banded buckets, star-shaped candidate edges.

1. Each document becomes the set of hashes of its word shingles. Documents of equal sets form a
   class, and only one member of a class goes on.
2. One hash of a shingle gives its bin and its value; a bin keeps its least value, and an empty bin
   borrows from the first non-empty bin that its own probe sequence meets (optimal densification).
   Groups of bins are bands; classes that agree in a band share a bucket.
3. A bucket's candidate edges form a star around its first class, so their number is that of its
   members. Each is confirmed on the full sets.
4. A star alone would lose a link between two members of which one is not like the centre. Links
   matter only between components, so where the members of one centre are still in several, those
   outside the centre's own component are compared with all others: intersections of the full sets
   from an inverted index of a tile of members, except where the triangle inequality (the Jaccard
   distance is a metric) rules a link out. Only links come out that join components of the tile.
5. Components of the confirmed links by label propagation with pointer jumping, each round written
   to the shared folder.

Misses: a pair at the least similarity shares no band with probability (1 - s^rows)^bands, 3e-6 for
the defaults at 0.8, and much less above.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import HELD, text_slices
from .shared import content_key, content_sha, drop_written, hot_keys, kept_once, keyed_join, written

#: Members, and shingles of them, of a tile on average: tiles, not groups, bound a task.
TILE, TILE_SHINGLES = 1024, 400_000


@dataclass(frozen=True)
class NearConfig:
    """shingle_words words in a row make a shingle; a link needs intersection / union >= numerator / denominator."""

    shingle_words: int = 5
    numerator: int = 4
    denominator: int = 5
    bands: int = 32
    rows: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Words(dict):
    """Word -> 64-bit hash, of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        if not self:
            HELD["words"] = self.clear
        h = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = _Words()


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles: A-Z lower-cased, words between ASCII spaces; a text of
    fewer words is one shingle, one without words the empty set."""
    split = text.encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, split), np.uint64, len(split))
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(words, len(h)), np.uint64)
    for k in range(min(words, len(h))):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


@lru_cache(maxsize=8)
def _probes(bins: int, attempt: int) -> np.ndarray:
    """Where each bin looks at an attempt."""
    i = np.arange(bins, dtype=np.uint64)
    step = np.uint64(attempt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (_mixed(_mixed(i + np.uint64(1)) + step) % np.uint64(bins)).astype(np.int64)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One value a bin; hashes must not be empty."""
    h = _mixed(hashes + np.uint64(0x5851F42D4C957F2D))
    bin_ = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    value = _mixed(h)
    order = np.argsort(bin_, kind="stable")
    sorted_bins = bin_[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_bins[1:] != sorted_bins[:-1]]))
    out, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    out[sorted_bins[starts]] = np.minimum.reduceat(value[order], starts)
    full[sorted_bins[starts]] = True
    empty, attempt = np.flatnonzero(~full), 0
    while len(empty):
        at = _probes(bins, attempt)[empty]
        found = full[at]
        out[empty[found]] = out[at[found]]
        empty, attempt = empty[~found], attempt + 1
    return out


def band_keys(sig: np.ndarray, config: NearConfig) -> np.ndarray:
    parts = sig.reshape(config.bands, config.rows)
    key = np.arange(1, config.bands + 1, dtype=np.uint64)
    for k in range(config.rows):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return key.astype(np.int64)


def _sketches(docs: DataFrame, config: NearConfig) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "text", own="words"):
            n, digest, bands, sigs = [], [], [], []
            for text in texts:
                hashes = shingle_set(text, config.shingle_words)
                n.append(len(hashes))
                if len(hashes):
                    sig = signature(hashes, config.bins)
                    digest.append(blake2b(hashes.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(sig, config).tolist())
                    sigs.append(sig.astype("<u2").tobytes())
                else:
                    digest.append(None)
                    bands.append(None)
                    sigs.append(None)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "id", "key", "sha")), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], names=["row", "id", "key", "sha", "n", "digest", "bands", "sig"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"row long, id {kind}, key long, sha binary, n long, digest binary, bands array<long>, sig binary")


def _full_sets(docs: DataFrame, wanted: DataFrame, config: NearConfig) -> DataFrame:
    """(node, hashes) of the wanted (node, first_id, first_key, digest): the texts of their first rows are read
    again, found by id and content key."""
    texts = docs.select("id", "key", "text").join(wanted, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "text", own="words"):
            keep, sets = [], []
            for i, (text, digest) in enumerate(zip(texts, part.column("digest").to_pylist(), strict=True)):
                packed = shingle_set(text, config.shingle_words).tobytes()
                if blake2b(packed, digest_size=16).digest() == digest:  # the key is a hash: the digest decides
                    keep.append(i)
                    sets.append(packed)
            yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(keep, pa.int64())), pa.array(sets, pa.binary())], names=["node", "hashes"])

    found = texts.select("node", "digest", "text").mapInArrow(run, "node long, hashes binary")
    return written(found.dropDuplicates(["node"]), "near-sets")


def _least_alike(size: np.ndarray, config: NearConfig) -> np.ndarray:
    """The share of equal bins below which a pair of sets, the smaller of this size, can't be a link: six
    standard deviations under the link's similarity."""
    s = config.numerator / config.denominator
    return s - 6 * np.sqrt(s * (1 - s) / np.minimum(config.bins, size))


def _confirmed(pairs: DataFrame, sigs: DataFrame, sets: DataFrame, config: NearConfig) -> DataFrame:
    """(a, b, distance, linked) of the pairs (a, b) that signatures don't rule out, from the full sets."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, config.bins) for c in ("asig", "bsig"))
            small, large = np.minimum(*(sizes := [batch.column(c).to_numpy() for c in ("an", "bn")])), np.maximum(*sizes)
            keep = ((x == y).mean(axis=1) >= _least_alike(small, config)) & (config.denominator * small >= config.numerator * large)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distance, linked = [], []
            for x, y in zip(batch.column("ah"), batch.column("bh"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - both
                distance.append(1 - both / union)
                linked.append(config.denominator * both >= config.numerator * union)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(distance, pa.float64()), pa.array(linked, pa.bool_())], names=["a", "b", "distance", "linked"])

    sig = lambda x: sigs.select(F.col("node").alias(x), F.col("n").alias(f"{x}n"), F.col("sig").alias(f"{x}sig"))
    left = pairs.join(sig("a"), "a").join(sig("b"), "b").select("a", "b", "an", "bn", "asig", "bsig").mapInArrow(possible, "a long, b long")
    full = lambda x: sets.select(F.col("node").alias(x), F.col("hashes").alias(f"{x}h"))
    both = left.join(full("a"), "a").join(full("b"), "b").select("a", "b", "ah", "bh")
    return written(both.mapInArrow(confirm, "a long, b long, distance double, linked boolean").dropDuplicates(["a", "b"]), "near-pairs")


def _beside_the_stars(members: DataFrame, star: DataFrame, roots: DataFrame, sigs: DataFrame, sets: DataFrame, config: NearConfig) -> DataFrame:
    """Links (a, b) between members of one centre that the stars leave in different components.

    members: distinct (hub, node), without the hub itself. Members outside the hub's component
    (small) meet all members, in tiles of small by tiles of all.
    """
    reach = 1 - config.numerator / config.denominator + 1e-9
    known = star.select(F.col("a").alias("sa"), F.col("b").alias("sb"), "distance")
    rows = members.join(known, (F.col("hub") == F.col("sa")) & (F.col("node") == F.col("sb")), "left").drop("sa", "sb")
    for name in ("hub", "node"):
        of = roots.select(F.col("node").alias("of"), F.col("root").alias(f"{name}_root"))
        rows = rows.join(of, F.col(name) == F.col("of"), "left").drop("of").withColumn(f"{name}_root", F.coalesce(f"{name}_root", name))
    rows = rows.join(sigs.select(F.col("node").alias("of"), "n"), F.col("node") == F.col("of")).drop("of")
    rows = written(rows.withColumn("small", F.col("hub_root") != F.col("node_root")), "near-placed")
    tiles = lambda count, size: F.greatest(F.ceil(count / TILE), F.ceil(size / TILE_SHINGLES)).cast("int")
    groups = rows.groupBy(F.col("hub").alias("of")).agg(
        F.min("node_root").alias("low"), F.max("node_root").alias("high"),
        tiles(F.count_if("small"), F.coalesce(F.sum(F.when(F.col("small"), F.col("n"))), F.lit(0))).alias("small_tiles"), tiles(F.count(F.lit(1)), F.sum("n")).alias("all_tiles"),
    ).where("low <> high")
    open_ = written(rows.join(groups, F.col("hub") == F.col("of")).select("hub", "node", F.col("node_root").alias("root"), F.coalesce("distance", F.lit(float("nan"))).alias("distance"), "small", "small_tiles", "all_tiles"), "near-open")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = open_.where("small").select("hub", own("small_tiles").alias("i"), every("all_tiles").alias("j"), F.lit(True).alias("asks"), "node", "root", "distance")
    right = open_.select("hub", own("all_tiles").alias("j"), every("small_tiles").alias("i"), F.lit(False).alias("asks"), "node", "root", "distance")
    dealt = left.unionByName(right).join(sets.select(F.col("node").alias("of"), "hashes"), F.col("node") == F.col("of")).drop("of")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False)
        sides = [table.filter(pa.array(x)) for x in (asks, ~asks)]
        (p_node, p_root, p_far), (q_node, q_root, q_far) = ([t[c].to_numpy().copy() for c in ("node", "root", "distance")] for t in sides)
        packed = [[np.frombuffer(x.as_buffer(), "<u8") for x in t["hashes"].combine_chunks()] for t in sides]
        size = np.array([len(x) for x in packed[1]], np.int64)
        flat = np.concatenate(packed[1]) if packed[1] else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        values, owner = flat[order], np.repeat(np.arange(len(size)), size)[order]
        found_a, found_b = [], []
        for k, mine in enumerate(packed[0]):
            fits = (q_root != p_root[k]) & ~(np.abs(q_far - p_far[k]) > reach) & (config.denominator * np.minimum(size, len(mine)) >= config.numerator * np.maximum(size, len(mine)))
            if not fits.any():
                continue
            begin, end = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
            n = end - begin
            at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            both = np.bincount(owner[at], minlength=len(size))
            hits = np.flatnonzero(fits & (config.denominator * both >= config.numerator * (size + len(mine) - both)))
            roots_, first = np.unique(q_root[hits], return_index=True)
            for q in hits[first].tolist():
                found_a.append(p_node[k])
                found_b.append(q_node[q])
            if len(hits):  # one component from here on: a tile gives fewer links than it has members
                mine_root = p_root[k]
                q_root[np.isin(q_root, roots_)] = mine_root
                p_root[np.isin(p_root, roots_)] = mine_root
        return pa.table({"a": np.array(found_a, np.int64), "b": np.array(found_b, np.int64)})

    return written(dealt.groupBy("hub", "i", "j").applyInArrow(compare, "a long, b long"), "near-beside")


def _all_links(bands: DataFrame, sigs: DataFrame, sets: DataFrame, config: NearConfig) -> DataFrame:
    """Links (a, b) that connect what the buckets' links connect. bands: (band, node) of shared buckets."""
    hubs = bands.groupBy("band").agg(F.min("node").alias("hub"))
    members = written(keyed_join(bands, hubs, "band").where("node <> hub").select("hub", "node").distinct(), "near-members")
    star = _confirmed(members.select(F.col("hub").alias("a"), F.col("node").alias("b")), sigs, sets, config)
    linked = star.where("linked").select("a", "b")
    return linked.unionByName(_beside_the_stars(members, star, components(linked), sigs, sets, config))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the least node that it is connected with.

    Each round takes the least root among neighbours and then that root's own root, so long chains
    shrink fast; rounds are written, so no round is computed again.
    """
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b"), "near-edges")
    hubs = hot_keys(edges, "b")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "near-labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("root").alias("theirs"))
        least = keyed_join(edges, of, "b", hot=hubs).groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        step = written(labels.join(least, "node").select("node", F.col("root").alias("before"), F.least("root", "theirs").alias("root")), "near-step")
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        new = written(keyed_join(step, up, "root", "left").select("node", "before", F.least("root", "higher").alias("root")), "near-labels")
        changed = new.where("root <> before").limit(1).count()
        drop_written(step)
        labels = new.select("node", "root")
        if not changed:
            drop_written(edges)
            return labels


def near_duplicates(docs: DataFrame, config: NearConfig = NearConfig(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of whole texts.

    component_id is the least id that the row is connected with by links; null texts and texts without
    words have empty sets and stand alone. A row without an id takes part, but never names a
    component unless all its members lack one. kept: the id is the component's. Rows that repeat an
    id and a text are in one component and all say kept; an empty table gives no rows.
    """
    rows = _grouped(docs, config, text_col, id_col)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))


def without_near_copies(docs: DataFrame, config: NearConfig = NearConfig(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each component, the one with the least id, with all its columns. Rows without words stay."""
    rows = written(_grouped(docs, config, text_col, id_col), "near-rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    first = rows.where("root is not null").groupBy("root").agg(F.min(F.struct(order.alias("o"), "key", "id", "sha")).alias("first")).select("first.key", "first.id", "first.sha")
    return kept_once(docs, first.unionByName(rows.where("root is null").select("key", "id", "sha")), id_col, text_col)


def _grouped(docs: DataFrame, config: NearConfig, text_col: str, id_col: str) -> DataFrame:
    """(row, id, key, sha, n, root, component_id); root, a component's number, is null for empty sets."""
    chosen = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), content_key(id_col, text_col).alias("key"), content_sha(text_col).alias("sha"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sketches = written(_sketches(chosen, config), "near-sketches")
    classes = sketches.where("digest is not null").groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("first.id").alias("first_id"), F.col("first.key").alias("first_key")), "near-classes")
    of = classes.select("node", F.col("digest").alias("class"), "first_id", "first_key")
    first = sketches.join(of, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")) & (F.col("digest") == F.col("class")))
    first = written(first.select("node", "n", "bands", "sig").dropDuplicates(["node"]), "near-firsts")
    bands = first.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy(F.col("band").alias("of")).agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("of")
    bands = written(bands.join(shared, F.col("band") == F.col("of")).select("band", "node"), "near-bands")
    wanted = classes.join(bands.select(F.col("node").alias("wanted")).distinct(), F.col("node") == F.col("wanted")).select("node", "first_id", "first_key", "digest")
    sets = _full_sets(chosen, wanted, config)
    links = _all_links(bands, first.select("node", "n", "sig"), sets, config)
    roots = components(links)
    placed = written(classes.join(roots.withColumnRenamed("node", "linked_node"), F.col("node") == F.col("linked_node"), "left").select("digest", "first_id", F.coalesce("root", "node").alias("root")), "near-placed")
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(keyed_join(placed, least, "root").select("digest", "component_id", "root"), "near-named")
    drop_written(first, bands, sets, classes, placed)
    joined = keyed_join(sketches.select("row", "id", "key", "sha", "n", "digest"), named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select("row", "id", "key", "sha", "n", "root", component.alias("component_id"))
