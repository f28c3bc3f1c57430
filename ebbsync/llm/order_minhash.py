"""Near-duplicate classes by Order MinHash.

A text is a sequence of five-word shingles, each labelled with which occurrence
of it this is. For each of ``BANDS`` random orders the ``KEPT`` least shingles
are taken and put back into text order; their hash is the text's bucket in that
band. Two texts share a bucket about with the ``KEPT``-th power of their
similarity, and only if the shared shingles come in the same order, which is what
makes the sketch follow edit similarity rather than overlap alone. A short text
has few shingles to choose from, so there a change would be in most bands. Texts of
up to ``SHORT`` shingles have their rarest shingles as buckets besides, enough of
them that any two that are similar share one.

Candidates are verified by aligning the two shingle sequences within a band of
diagonals: with ``m`` aligned shingles of ``a`` and ``b``, their similarity is
``m / (a + b - m)``, and texts of 0.8 or more are linked. Classes are the
connected components.

Equal texts are one node from the start, so a group of copies costs one sketch.
Within a bucket each node is compared with one, the leader. Where nodes of a
bucket stay in different components, all its pairs of two components are
considered, and those that no exact bound rules out are compared. So no two
similar texts of a bucket end apart, and a group of near copies that its leader
holds together costs a comparison per member.

Defined results: null and empty texts are equal texts without shingles. A text of
one to four words has one shingle. A class is named by its least ``doc_id``
(null if it has none). Repeated rows are copies. An empty table gives an empty
result. Input columns of any name are carried along by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbsync.functions.sizes import broadcast_if, fits
from ebbsync.llm.components import components
from ebbsync.llm.hashing import WordHashes, mix, run_hashes
from ebbsync.llm.text import MIN_SIMILARITY, as_rows, text_key
from ebbsync.session import work_dir, written

BANDS = 24
KEPT = 6
#: Shingles up to which similar texts are found by a shingle in common. Up to 0.8 of it no text needs bands.
SHORT = 50
#: Nodes or removed rows up to which a key set is broadcast: 32 bytes each.
BROADCAST_ROWS = 200_000
#: Shingles of a block of a bucket whose pairs are all considered: eight bytes each, two blocks at a time.
BLOCK_SHINGLES = 500_000
#: Shingles above which bands are sketched one after another, to bound memory.
_WIDE = 50_000

_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")




def label_occurrences(shingles: np.ndarray) -> np.ndarray:
    """Shingle hashes made distinct by which occurrence of the shingle each is."""
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return shingles
    at = np.arange(len(ordered))
    occurrence = at - np.maximum.accumulate(np.where(new, at, 0))
    labelled = np.empty_like(shingles)
    labelled[order] = mix(ordered + mix(occurrence.astype(np.uint64)) * (occurrence > 0))
    return labelled


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The bucket of a shingle sequence in each band; none where all that is similar is short."""
    if len(shingles) <= MIN_SIMILARITY * SHORT:
        return np.empty(0, dtype=np.int64)
    labelled = label_occurrences(shingles)
    kept = KEPT

    def least(seeds: np.ndarray) -> np.ndarray:
        order = mix(labelled[None, :] ^ seeds[:, None])
        return np.argpartition(order, kept - 1, axis=1)[:, :kept]

    if len(labelled) > _WIDE:
        chosen = np.concatenate([least(_SEEDS[i : i + 1]) for i in range(BANDS)])
    else:
        chosen = least(_SEEDS)
    in_text_order = labelled[np.sort(chosen, axis=1)]
    total = _SEEDS.copy()
    for i in range(kept):
        total = mix(total + in_text_order[:, i])
    return total.view(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        bands, short = [], []
        for text in batch.column("text"):
            shingles = run_hashes(hashes.of(text.as_py().split()))
            bands.append(sketch(shingles))
            short.append(label_occurrences(shingles).view(np.int64) if len(shingles) <= SHORT else [])
        arrays = [pa.array(values, pa.list_(pa.int64())) for values in (bands, short)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), *arrays], names=["doc_id", "key", "bands", "short"]
        )


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        packed = [run_hashes(hashes.of(t.as_py().split())).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], names=["id", "shingles"])


def aligned(a: np.ndarray, b: np.ndarray, least: int, band: int) -> int:
    """Length of the longest common subsequence within ``band`` diagonals, 0 if it is under ``least``.

    A row of the alignment table is one integer: bit ``j`` is clear where the
    subsequence grows at position ``j`` of ``a``. Positions that leave the band
    are counted and shifted out; those that enter it are set.
    """
    places: dict[int, list[int]] = {}
    for j, shingle in enumerate(a.tolist()):
        places.setdefault(shingle, []).append(j)
    low, high, row, found = 0, 0, 0, 0
    for i, shingle in enumerate(b.tolist()):
        reach = min(len(a), i + band + 1)
        if reach > high:
            row |= ((1 << (reach - high)) - 1) << (high - low)
            high = reach
        start = min(max(0, i - band), high)
        if start > low:
            gone = start - low
            found += gone - (row & ((1 << gone) - 1)).bit_count()
            row >>= gone
            low = start
        match = 0
        for j in places.get(shingle, ()):
            if low <= j < high:
                match |= 1 << (j - low)
        if match:
            grown = row & match
            row = ((row + grown) | (row - grown)) & ((1 << (high - low)) - 1)
    found += (high - low) - row.bit_count()
    return found if found >= least else 0


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Aligned shingles over all, or 0 where that is surely under ``MIN_SIMILARITY``."""
    total, short = len(a) + len(b), min(len(a), len(b))
    if short == 0:
        return 0.0
    least = int(np.ceil(total * MIN_SIMILARITY / (1 + MIN_SIMILARITY) - 1e-9))
    if short < least:
        return 0.0
    equal = a[:short] == b[:short]
    head = short if equal.all() else int(np.argmin(equal))
    a, b = a[head:], b[head:]
    short -= head
    equal = a[len(a) - short :][::-1] == b[len(b) - short :][::-1]
    tail = short if equal.all() else int(np.argmin(equal))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    same = head + tail
    if len(a) and len(b):
        if same + len(np.intersect1d(a, b)) * 4 < least and same + _shared(a, b) < least:
            return 0.0
        same += aligned(a, b, 0, max(0, total - 2 * least))
    return same / (total - same)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles in common, repeats counted: no alignment has more."""
    values, n_a = np.unique(a, return_counts=True)
    others, n_b = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(values, others, assume_unique=True, return_indices=True)
    return int(np.minimum(n_a[i], n_b[j]).sum())


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [
            similarity(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
            for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True)
        ]
        columns = [batch.column("a"), batch.column("b"), pa.array(scores, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "similarity"])


def _kept_schema(df: DataFrame, *names: str) -> str:
    return ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.filter(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def block_links(ids: np.ndarray, labels: np.ndarray, sides: np.ndarray, packed: list[bytes]) -> list[tuple[int, int]]:
    """Links between a block's nodes, as many as join what is similar in it: every pair of two components is considered.

    With two sides in the block, pairs are of one node of each. A pair is passed
    over only where it cannot be similar enough: by its sizes, by having none of
    the rarest shingles in common that one of any similar pair must be among, or
    by its shingles in common.
    """
    texts = [np.frombuffer(p, np.uint64) for p in packed]
    sizes = np.array([len(t) for t in texts])
    n = len(texts)
    _, place = np.unique(np.concatenate([label_occurrences(t) for t in texts]), return_inverse=True)
    node = np.repeat(np.arange(n), sizes)
    rare_first = np.lexsort((place, np.bincount(place)[place], node))
    place = place[rare_first]
    start = np.cumsum(sizes) - sizes
    rarest = sizes - np.ceil(MIN_SIMILARITY * sizes - 1e-9).astype(int) + 1
    in_prefix = np.arange(len(node)) - start[node] < rarest[node]

    def index(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = chosen[np.argsort(place[chosen], kind="stable")]
        return node[order], np.searchsorted(place[order], np.arange(place.max() + 2))

    all_nodes, all_starts = index(np.arange(len(node)))
    nodes, starts = index(np.flatnonzero(in_prefix))
    two_sided = len(np.unique(sides)) > 1
    labels, links = labels.copy(), []
    for x in range(n):
        own = place[start[x] : start[x] + sizes[x]]
        met = np.unique(np.concatenate([nodes[starts[s] : starts[s + 1]] for s in own[: rarest[x]]]))
        met = met[(met > x) & (labels[met] != labels[x])]
        if two_sided:
            met = met[sides[met] != sides[x]]
        short, long = np.minimum(sizes[met], sizes[x]), np.maximum(sizes[met], sizes[x])
        met = met[short >= MIN_SIMILARITY * long - 1e-9]
        if len(met) == 0:
            continue
        shared = np.bincount(np.concatenate([all_nodes[all_starts[s] : all_starts[s + 1]] for s in own]), minlength=n)[met]
        met = met[shared * (1 + MIN_SIMILARITY) >= MIN_SIMILARITY * (sizes[met] + sizes[x]) - 1e-9]
        for y in met.tolist():
            if labels[x] != labels[y] and similarity(texts[x], texts[y]) >= MIN_SIMILARITY:
                links.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                labels[labels == labels[y]] = labels[x]
    return links


def _link_block(block: pa.Table) -> pa.Table:
    ids, labels, sides = (block.column(c).to_numpy() for c in ("id", "label", "side"))
    links = block_links(ids, labels, sides, block.column("shingles").to_pylist())
    return pa.table({c: pa.array([link[i] for link in links], pa.int64()) for i, c in enumerate("ab")})


class NearDuplicates:
    """The classes of one table of documents. Intermediate tables go to the shared folder."""

    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        self.docs = docs
        keyed = docs.select("doc_id", _bytes(F.col("text")).alias("text"), text_key(F.col("text")).alias("key"))
        schema = _kept_schema(keyed, "doc_id", "key") + ", bands array<bigint>, short array<bigint>"
        self.sketches = self._table(keyed.mapInArrow(_sketch_batches, schema), "sketches")
        own = (F.first(name).alias(name) for name in ("bands", "short"))
        nodes = self.sketches.groupBy("key").agg(F.min("doc_id").alias("doc_id"), *own)
        self.nodes = self._table(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
        self.labels = self._classes()

    def _table(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, work_dir(self.spark, name))

    def _short_buckets(self) -> DataFrame:
        """The rarest shingles of each short text, as buckets.

        Of two texts with shingles ordered alike, one's first ``n - ceil(0.8 n) + 1``
        and the other's have one in common if they are similar. With the rarest
        first, buckets are small.
        """
        each = self.nodes.select("id", F.size("short").alias("n"), F.explode("short").alias("bucket"))
        each = self._table(each, "short")
        often = each.groupBy("bucket").agg(F.count("*").alias("times"))
        order = F.array_sort(F.collect_list(F.struct("times", "bucket"))).alias("order")
        ordered = each.join(often, "bucket").groupBy("id", "n").agg(order)
        first = F.floor((1 - MIN_SIMILARITY) * F.col("n") + 1e-9).cast("int") + 1
        rarest = ordered.select("id", F.explode(F.slice("order", F.lit(1), first)).alias("s")).filter("s.times > 1")
        return rarest.select("id", F.lit(BANDS).alias("band"), F.col("s.bucket").alias("bucket"))

    def _members(self) -> DataFrame:
        """Nodes of every bucket that has more than one, with the bucket's leader.

        The leader is the node that meets most others in all its buckets: in a
        group of copies that is one near their common origin, which is similar to
        more of them than any other. Any other choice would cost more comparisons
        and give the same classes.
        """
        placed = self.nodes.select("id", F.posexplode("bands").alias("band", "bucket"))
        placed = self._table(placed.unionByName(self._short_buckets()), "placed")
        shared = placed.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
        shared = self._table(placed.join(shared, ["band", "bucket"]), "shared")
        met = shared.groupBy("id").agg(F.sum("n").alias("met"))
        shared = self._table(shared.drop("n").join(met, "id"), "met")
        leader = F.min(F.struct(-F.col("met"), "id"))["id"].alias("leader")
        return shared.join(shared.groupBy("band", "bucket").agg(leader), ["band", "bucket"])

    def _verified(self, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The pairs whose texts are similar enough, and the shingles of all nodes that are in a pair."""
        pairs = self._table(pairs.distinct(), "pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        keys = self._table(self.nodes.select("id", "key").join(wanted, "id", "left_semi"), "wanted")
        texts = self.docs.select(text_key(F.col("text")).alias("key"), _bytes(F.col("text")).alias("text"))
        texts = texts.join(broadcast_if(keys, fits(keys, BROADCAST_ROWS)), "key")
        one_each = texts.groupBy("id").agg(F.first("text").alias("text"))
        shingled = self._table(one_each.mapInArrow(_shingle_batches, "id bigint, shingles binary"), "shingles")
        both = pairs.join(shingled.withColumnsRenamed({"id": "a", "shingles": "shingles_a"}), "a").join(
            shingled.withColumnsRenamed({"id": "b", "shingles": "shingles_b"}), "b"
        )
        scored = both.mapInArrow(_verify_batches, "a bigint, b bigint, similarity double")
        return scored.filter(F.col("similarity") >= MIN_SIMILARITY).select("a", "b"), shingled

    def _classes(self) -> DataFrame:
        """The least node of each linked node's class."""
        members = self._table(self._members(), "members")
        verified, shingled = self._verified(_pairs(members, "leader", "id"))
        links = self._table(verified, "links")
        labels = components(links, "a", "b")
        more = self._table(self._still_apart(members, labels, shingled), "links")
        if more.isEmpty():
            return labels
        return components(links.unionByName(more), "a", "b")

    def _still_apart(self, members: DataFrame, labels: DataFrame, shingled: DataFrame) -> DataFrame:
        """Links in buckets whose nodes are in more than one component, found by comparing all their pairs.

        The leader was compared with all and stays out. A bucket is dealt into
        blocks by its shingles, and every two of its blocks are a task's group, so
        no group grows with the bucket.
        """
        bucket = ["band", "bucket"]
        labelled = members.filter("id != leader").select("id", *bucket).join(labels, "id", "left")
        labelled = self._table(labelled.withColumn("label", F.coalesce("label", "id")), "labelled")
        mixed = labelled.groupBy(bucket).agg(F.min("label").alias("low"), F.max("label").alias("high"))
        apart = labelled.join(mixed.filter("low < high").select(bucket), bucket)
        sizes = shingled.select("id", (F.length("shingles") / 8).alias("n_shingles"))
        apart = self._table(apart.join(sizes, "id"), "apart")
        total = F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks")
        dealt = apart.join(apart.groupBy(bucket).agg(total), bucket)
        dealt = dealt.withColumn("side", F.pmod(F.xxhash64("id"), "blocks"))
        met = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("met")
        dealt = dealt.select("id", "label", *bucket, "side", met)
        dealt = dealt.select("id", "label", *bucket, "side", F.least("side", "met").alias("low"), F.greatest("side", "met").alias("high"))
        blocks = dealt.join(shingled, "id").groupBy(*bucket, "low", "high")
        return blocks.applyInArrow(_link_block, "a bigint, b bigint").distinct()

    def members(self) -> DataFrame:
        """One row per document: ``doc_id``, ``key`` of its text, and ``class_id``."""
        named = self.nodes.select("key", "doc_id", "id").join(self.labels, "id", "left")
        named = named.withColumn("label", F.coalesce("label", "id"))
        names = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
        classes = named.select("key", "label").join(names, "label").select("key", "label", "class_id")
        return self.sketches.select("doc_id", "key").join(classes, "key")

    def keep_one(self) -> DataFrame:
        """The input rows, one of each class: its least ``doc_id``, of the least text key where that ties."""
        rows = self._table(self.members(), "classes")
        one = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))
        stay = rows.groupBy("label").agg(one.alias("stay"))
        kept = rows.join(stay, "label").withColumn(
            "stays", F.col("doc_id").eqNullSafe(F.col("stay.doc_id")) & (F.col("key") == F.col("stay.key"))
        )
        kept = self._table(kept.select("doc_id", "key", "stays"), "kept")
        gone = kept.filter("NOT stays").select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")).distinct()
        gone = broadcast_if(gone, fits(gone, BROADCAST_ROWS))
        doc_id, key = F.col("row.doc_id"), F.col("key")
        keyed = as_rows(self.docs, key=text_key(self.docs["text"]))
        left = keyed.join(gone, (key == F.col("gone_key")) & doc_id.eqNullSafe(F.col("gone_id")), "left_anti")
        if not kept.filter("stays").groupBy("doc_id", "key").count().filter("count > 1").isEmpty():
            left = left.withColumn("doc_id", doc_id).dropDuplicates(["key", "doc_id"])
        return left.select("row.*")
