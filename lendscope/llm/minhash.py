"""MinHash near-dedup by one-permutation hashing.

A text's set holds the hashes of its distinct word shingles. One permutation serves all bins: a
hash's top bits name its bin and the bin keeps its smallest hash. Empty bins are filled by optimal
densification, each from the first non-empty bin of a probe sequence of its own, so that equal bins
stay as likely as the sets are similar. Bands of bins are buckets; at similarity 0.85 two sets miss
all 42 bands of 6 bins with a probability of about 2e-9.

Equal sets are one node. In a bucket every node is a candidate only with the bucket's centre, the
node with most company in all its buckets (a text that its copies derive from comes first): a star,
so a bucket of n nodes gives n - 1 pairs. Pairs are confirmed on the full sets. A bucket whose nodes
are then still in different components gets further stars around other centres, as long as that
settles a good part of them. What remains is compared tile by tile: signatures tell which rows have a
likely partner in another component, and these rows' full sets are compared all at once, by products
of incidence matrices; a task returns a spanning forest of the links, never the pairs. No bucket is
capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import SpanHasher, doc_key, materialize, mix64, slices, text_buffer, word_spans
from lendscope.llm.simhash import _join, components

BINS = 256
BAND_BINS = 6
BANDS = BINS // BAND_BINS
SHINGLE = 5
PERCENT = 85

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Shingles hashed at once: bounds the working arrays of a long text.
_AT_ONCE = 1 << 19


# --- sets and signatures -------------------------------------------------------------------------

def shingle_hashes(raw: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every shingle, shingles of each text). ``raw``: lower-cased bytes of texts in
    a row. A shingle is ``size`` words joined by one space; a shorter text is one shingle."""
    starts, ends, first = word_spans(raw, offsets)
    n_words = np.diff(first)
    counts = np.where(n_words == 0, 0, np.maximum(n_words - size + 1, 1))
    text = np.repeat(np.arange(len(counts)), counts)
    head = first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    tail = np.minimum(head + size, first[1:][text]) - 1
    out = np.empty(len(head), dtype=np.uint64)
    for lo in range(0, len(head), _AT_ONCE):
        h, t = head[lo:lo + _AT_ONCE], tail[lo:lo + _AT_ONCE]
        w0, w1 = int(h[0]), int(t.max()) + 1
        s, e = starts[w0:w1], ends[w0:w1]
        # The words of this part with one space after each.
        length = e - s + 1
        to = np.cumsum(length) - length
        joined = np.full(int(length.sum()), 32, dtype=np.uint8)
        place = np.arange(len(joined)) - np.repeat(to, length)
        inside = place < np.repeat(e - s, length)
        joined[inside] = raw[(np.repeat(s, length) + place)[inside]]
        out[lo:lo + _AT_ONCE] = SpanHasher(joined)(to[h - w0], to[t - w0] + (e - s)[t - w0])
    return out, counts


def distinct_by_text(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text in ascending order, and their number."""
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    fresh = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])][:len(hashes)]
    return hashes[fresh], np.bincount(text[fresh], minlength=len(counts))


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of ``BINS`` minima for each text with a set, densified."""
    text = np.repeat(np.arange(len(counts)), counts)
    at = (hashes >> np.uint64(56)).astype(np.int64)
    # Ascending hashes: the first of a bin is its minimum.
    first = np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])][:len(at)]
    own = np.full((len(counts), BINS), _EMPTY)
    own[text[first], at[first]] = hashes[first]
    filled = own.copy()
    row, col = np.nonzero(own == _EMPTY)
    some = counts[row] > 0
    row, col = row[some], col[some]
    attempt = 1
    while len(row):
        probe = (mix64(col.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt)) & np.uint64(BINS - 1)).astype(np.int64)
        value = own[row, probe]
        got = value != _EMPTY
        filled[row[got], col[got]] = value[got]
        row, col = row[~got], col[~got]
        attempt += 1
    return filled


def band_hashes(filled: np.ndarray) -> np.ndarray:
    """(texts x ``BANDS``) a hash of each band's bins."""
    bins = filled[:, :BANDS * BAND_BINS].reshape(len(filled), BANDS, BAND_BINS)
    out = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), bins.shape[:2]).copy()
    for i in range(BAND_BINS):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + bins[:, :, i])
    return out


def _least_linkable(percent: int) -> int:
    """Smaller sets than this link only with equal ones."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def _set_key(part: np.ndarray) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(part.tobytes())


def shingle_rows(df: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """``doc_id, key_id, key_text, n, key, bands, sig`` of every row: size and 128-bit key of the
    set (null if empty), and for sets that can link with others the buckets and a byte of each bin."""
    least = _least_linkable(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            raw, offsets = text_buffer(batch.column(3))
            hashes, counts = distinct_by_text(*shingle_hashes(_LOWER[raw], offsets, shingle))
            edges = np.r_[0, np.cumsum(counts)]
            keys = [_set_key(hashes[lo:hi]) if hi > lo else None for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            large = counts >= least
            filled = signatures(hashes[np.repeat(large, counts)], counts[large])
            bands, sig = band_hashes(filled).view(np.int64), (mix64(filled) & np.uint64(255)).astype(np.uint8)
            ends = np.cumsum(large)
            list_ends = np.r_[0, ends * BANDS].astype(np.int32)
            at = (ends - 1).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(counts.astype(np.int64)), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(list_ends), pa.array(bands.ravel())),
                 pa.array([sig[i].tobytes() if ok else None for i, ok in zip(at, large.tolist(), strict=True)], pa.binary())],
                names=["doc_id", "key_id", "key_text", "n", "key", "bands", "sig"])

    text = df[text_col].cast("string")
    rows = df.select(df[id_col].cast("long").alias("doc_id"), *doc_key(id_col, text_col), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, key_id long, key_text long, n long, key binary, bands array<long>, sig binary")


def _hash_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``key, n, hashes`` of rows ``key, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            raw, offsets = text_buffer(batch.column(1))
            hashes, counts = distinct_by_text(*shingle_hashes(_LOWER[raw], offsets, shingle))
            ends = np.r_[0, np.cumsum(counts)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))],
                names=["key", "n", "hashes"])

    return texts.select("key", "text").mapInArrow(run, "key binary, n long, hashes array<long>")


# --- candidates ------------------------------------------------------------------------------------

def _could_link(n: str, m: str, percent: int) -> F.Column:
    """Whether sets of these sizes can be similar enough at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough. ``a`` is a star's centre, so its set is
    joined to many pairs: a sort merge join, of which Spark splits the large partitions."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("an"), F.col("hashes").alias("ah"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("bn"), F.col("hashes").alias("bh"))
    common = F.size(F.array_intersect("ah", "bh"))
    return (pairs.join(left, "a").join(right, "b")
            .where(common * 100 >= (F.col("an") + F.col("bn") - common) * percent).select("a", "b"))


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one ``bucket`` at a time, of partitions that hold whole buckets, sorted."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        bucket = held["bucket"].to_numpy()
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield held.slice(lo, hi - lo)
        held = held.slice(int(edges[-1]))  # the last bucket may go on
    if held is not None and held.num_rows:
        yield held


def _groups(root: pa.ChunkedArray) -> np.ndarray:
    """A number for each component."""
    return root.combine_chunks().dictionary_encode().indices.to_numpy()


def _sizes_fit(n: np.ndarray, m, percent: int) -> np.ndarray:
    return np.minimum(n, m) * 100 >= np.maximum(n, m) * percent


def _with_likely_partner(dealt: DataFrame, agree: int, percent: int) -> DataFrame:
    """The rows ``bucket, key, root`` that have a partner in their bucket: another component, a size
    that can link, and a signature that agrees in ``agree`` bins or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_buckets(batches):
            n, group = rows["n"].to_numpy(), _groups(rows["root"])
            sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), dtype=np.uint8).reshape(-1, BINS)
            hit = np.zeros(len(n), dtype=bool)
            for i in range(len(n) - 1):
                may = np.flatnonzero((group[i + 1:] != group[i]) & _sizes_fit(n[i + 1:], n[i], percent)) + i + 1
                near = may[(sig[may] == sig[i]).sum(1) >= agree]
                hit[near] = True
                hit[i] |= len(near) > 0
            if hit.any():
                yield from rows.select(["bucket", "key", "root"]).filter(pa.array(hit)).combine_chunks().to_batches()

    return (dealt.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "key", "root", "n", "sig")
            .mapInArrow(run, "bucket long, key binary, root binary"))


def common_counts(hashes: np.ndarray, counts: np.ndarray, at_once: int = 4096) -> np.ndarray:
    """How many hashes every two of the sets share: products of blocks of the incidence matrix."""
    owner = np.repeat(np.arange(len(counts)), counts)
    _, place, often = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = often[place] > 1
    owner, place = owner[shared], (np.cumsum(often > 1) - 1)[place[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(counts), len(counts)), dtype=np.float32 if counts.max(initial=0) < 1 << 24 else np.float64)
    for lo in range(0, int(place[-1]) + 1 if len(place) else 0, at_once):
        some = slice(*np.searchsorted(place, [lo, lo + at_once]))
        incidence = np.zeros((len(counts), at_once), dtype=total.dtype)
        incidence[owner[some], place[some] - lo] = 1
        total += incidence @ incidence.T
    return total


def _bucket_links(dealt: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between rows ``bucket, key, root, n, hashes`` of a bucket and different
    components, on the full sets: a spanning forest, at most one link a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_buckets(batches):
            sets = rows["hashes"].combine_chunks()
            n, group, key = rows["n"].to_numpy(), _groups(rows["root"]), rows["key"].to_pylist()
            common = common_counts(sets.flatten().to_numpy(zero_copy_only=False), n)
            linked = common * 100 >= (n[:, None] + n[None, :] - common) * percent
            linked &= group[:, None] != group[None, :]
            label = _join(np.arange(len(n)), *np.nonzero(np.triu(linked)))
            moved = np.flatnonzero(label != np.arange(len(n)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array([key[i] for i in label[moved]], pa.binary()), pa.array([key[i] for i in moved], pa.binary())],
                                                 names=["a", "b"])

    return (dealt.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "key", "root", "n", "hashes")
            .mapInArrow(run, "a binary, b binary"))


def _tiles(rest: DataFrame, tile_rows: int) -> DataFrame:
    """The buckets of ``rest``; one over ``tile_rows`` is cut into parts, and every two parts meet
    in one tile."""
    sizes = (rest.groupBy("bucket").agg(F.count("*").alias("rows")).where(F.col("rows") > tile_rows)
             .select("bucket", F.ceil(F.col("rows") / tile_rows).cast("int").alias("tiles")))
    sized = rest.join(sizes, "bucket", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    mine = F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")
    return (sized.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .withColumn("bucket", F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")))
            .select("bucket", "key", "root", "n", "sig"))


def near_components(nodes: DataFrame, sets, percent: int = PERCENT, tile_rows: int = 1024) -> DataFrame | None:
    """``node, root`` of all nodes ``key, n, bands, sig`` that have confirmed links; ``sets`` gives
    the full sets of the keys asked for. ``None`` if nothing is linked."""
    dealt = nodes.select("key", "n", F.explode("bands").alias("bucket"))
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("company")).where("company > 1")
    members = materialize(dealt.join(sizes, "bucket"), "minhash-buckets")
    if members.isEmpty():
        return None
    company = members.groupBy("key").agg(F.sum("company").alias("company"))
    full = materialize(sets(company.select("key")), "minhash-sets")
    members = materialize(members.drop("company").join(company, "key").withColumn("root", F.col("key")), "minhash-members")
    links, found, size = None, None, members.count()
    while size:
        centres = members.groupBy("bucket").agg(F.max(F.struct("company", "key", "n", "root")).alias("c"))
        pairs = (members.join(centres, "bucket").where((F.col("root") != F.col("c.root")) & _could_link("n", "c.n", percent))
                 .select(F.col("c.key").alias("a"), F.col("key").alias("b")).distinct())
        confirmed = materialize(_confirmed(pairs, full, percent), "minhash-links")
        if not confirmed.isEmpty():
            links = confirmed if links is None else links.unionByName(confirmed)
            found = components(links)
            low = found.select(F.col("node").alias("key"), F.col("root").alias("low"))
            members = members.join(low, "key", "left").withColumn("root", F.coalesce("low", "root")).drop("low")
        # A centre is done in its bucket, and so is a bucket whose nodes are in one component.
        mixed = (members.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("rows"))
                 .where("lo <> hi AND rows > 2").join(centres.select("bucket", F.col("c.key").alias("centre")), "bucket"))
        members = materialize(members.join(mixed.select("bucket", "centre"), "bucket").where("key <> centre").drop("centre"), "minhash-members")
        before, size = size, members.count()
        if size > before * 4 // 5:  # stars find little more
            break
    if size:
        # Signatures of sets at the threshold agree in fewer bins with a probability of about 1e-9.
        share = percent / 100
        agree = int(BINS * (share - 6 * (share * (1 - share) / BINS) ** 0.5))
        rest = _tiles(members.join(nodes.select("key", "sig"), "key"), tile_rows)
        likely = materialize(_with_likely_partner(rest, agree, percent), "minhash-tiles")
        more = materialize(_bucket_links(likely.join(full, "key"), percent), "minhash-links")
        if not more.isEmpty():
            found = components(more if links is None else links.unionByName(more))
    return found


def minhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       percent: int = PERCENT, tile_rows: int = 1024) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id that links of ``100 * intersection >= percent * union`` of
    shingle sets reach, the row's own included; ``kept`` tells whether it is the row's id. Null,
    empty and blank texts have no shingles and link with nothing. A null id never names a component
    unless all its ids are null (then its rows are kept); repeated rows keep one row each. Very long
    texts enter whole, hashed in parts. Other columns are not read; an empty table gives no rows.
    """
    rows = materialize(shingle_rows(df, id_col, text_col, shingle, percent), "minhash-rows")
    nodes = materialize(rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("low_id"), F.min(F.struct("key_id", "key_text")).alias("rep"), F.first("n").alias("n"),
        F.first("bands").alias("bands"), F.first("sig").alias("sig")), "minhash-nodes")

    def sets(keys: DataFrame) -> DataFrame:
        wanted = nodes.join(keys, "key", "left_semi").select("key", "rep.key_id", "rep.key_text")
        texts = df.select(*doc_key(id_col, text_col), df[text_col].cast("string").alias("text"))
        # Rows repeated in id and text hold the same set.
        return _hash_sets(texts.join(wanted, ["key_id", "key_text"]).groupBy("key_id", "key_text")
                          .agg(F.first("key").alias("key"), F.first("text").alias("text")), shingle)

    found = near_components(nodes.where("sig IS NOT NULL"), sets, percent, tile_rows)
    if found is None:
        named = nodes.select("key", F.col("low_id").alias("component_id"))
    else:
        rooted = nodes.join(found, nodes["key"] == found["node"], "left").select("key", "low_id", F.coalesce("root", "key").alias("root"))
        smallest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
        named = rooted.join(smallest, "root").select("key", "component_id")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (rows.select("doc_id", "n", "key").join(named, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
