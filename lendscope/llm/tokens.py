"""Token counts and token ids of whole texts, with overlap resynchronisation for huge documents.

A document longer than ``chunk_chars`` is cut into overlapping chunks, dealt out as rows of
their own. Each chunk is encoded with offsets; neighbours are spliced at a boundary that both
encodings have and that is proven stable, and where the overlap holds none it is widened.

Stable boundary: the start of a token that follows a whitespace character and begins with
a character that is not a combining mark. For the tokenizers used here nothing crosses it: the
pre-tokenizer never joins across whitespace, special strings hold none, and normalisation (NFC,
lower case) treats each side alone. The tests hold it against whole-text encodings.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import doc_key, materialize, slices

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 256
#: Distinct words a Python worker remembers; beyond that words are encoded once per slice.
CACHE_WORDS = 600_000

_TOKENIZERS: dict = {}


def load(path: str):
    """The tokenizer of a file, once per process; ``path`` is read on every machine."""
    if path not in _TOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _TOKENIZERS[path] = (tokenizer, {})
    return _TOKENIZERS[path]


def encode_words(path: str, texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """Token ids (little-endian unsigned 32-bit) of the words of all texts in a row, and the
    number of words of each text.

    A text's ids are those of its words in order: words are separated by ASCII whitespace, a
    stable boundary on both sides, so each distinct word is encoded once by the library.
    """
    tokenizer, cache = load(path)
    words: list[bytes] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            own = text.encode().split()
            counts[i] = len(own)
            words += own
    ids = list(map(cache.get, words))
    missing = [i for i, got in enumerate(ids) if got is None]
    if missing:
        new = list({words[i] for i in missing})
        fresh: dict[bytes, bytes] = {}
        for begin in range(0, len(new), 4096):
            part = new[begin:begin + 4096]
            fresh.update(zip(part, _ids_of(tokenizer, part), strict=True))
        for i in missing:
            ids[i] = fresh[words[i]]
        room = CACHE_WORDS - len(cache)
        if room > 0:
            cache.update(list(fresh.items())[:room])
    return ids, counts


#: A word that stands between others when they are encoded as one text.
_MARK = b"|"


def _ids_of(tokenizer, words: list[bytes]) -> list[bytes]:
    """The ids of each word. Words without the mark are encoded as one text with marks between them,
    and cut at the mark's id; where the mark is no single id or the cuts don't come out even, and for
    words that hold the mark, each word is a text of its own."""
    plain = [w for w in words if _MARK not in w]
    done: dict[bytes, bytes] = {}
    mark = tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids
    if len(mark) == 1 and len(plain) > 1:
        text = (b" " + _MARK + b" ").join(plain).decode()
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        at = np.flatnonzero(ids == mark[0])
        if len(at) == len(plain) - 1:
            raw = ids.tobytes()
            begins, ends = np.r_[0, 4 * at + 4].tolist(), np.r_[4 * at, len(raw)].tolist()
            done = {w: raw[b:e] for w, b, e in zip(plain, begins, ends, strict=True)}
    rest = [w for w in words if w not in done]
    alone = tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False) if rest else []
    done.update((w, np.array(e.ids, dtype="<u4").tobytes()) for w, e in zip(rest, alone, strict=True))
    return [done[w] for w in words]


def document_ids(path: str, texts: list[str | None]) -> Iterator[bytes]:
    """The token ids of each text as little-endian unsigned 32-bit bytes."""
    ids, counts = encode_words(path, texts)
    at = 0
    for n in counts.tolist():
        yield b"".join(ids[at:at + n])
        at += n


def _word_counts(path: str, texts: list[str | None]) -> np.ndarray:
    ids, counts = encode_words(path, texts)
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    sums = np.r_[0, np.cumsum(sizes)]
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


# --- overlapping chunks -------------------------------------------------------------------------

def chunk_spans(n_chars: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """[begin, end) of the chunks: chunk k starts at ``k * chunk`` and reaches ``overlap`` past
    the start of the next."""
    return [(b, min(n_chars, b + chunk + overlap)) for b in range(0, max(n_chars, 1), chunk)]


def stable_boundaries(tokenizer, text: str, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Encode ``text[begin:end]``: (positions of stable token starts in the text, tokens before
    each of them in this encoding, tokens in all)."""
    part = text[begin:end]
    starts = np.array([s for s, _ in tokenizer.encode(part, add_special_tokens=False).offsets], dtype=np.int64)
    if not len(starts):
        return starts, starts, 0
    fresh = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1]])
    at = starts[fresh]
    stable = np.array([p > 0 and part[p - 1].isspace() and not unicodedata.combining(part[p]) for p in at.tolist()], dtype=bool)
    return at[stable] + begin, fresh[stable], len(starts)


def splice(chunks: list[tuple], n_chars: int) -> int | None:
    """Tokens of a text from its chunks in order, each ``(end, tokens, positions, before)`` with
    the stable boundaries it shares a zone for; None if two neighbours have none in common.

    The first common boundary ends the left chunk and starts the right one.
    """
    total, skipped = 0, 0
    for i, (end, tokens, positions, before) in enumerate(chunks):
        if end >= n_chars or i + 1 == len(chunks):
            return total + tokens - skipped
        _, _, next_positions, next_before = chunks[i + 1]
        common, a, b = np.intersect1d(positions, next_positions, assume_unique=True, return_indices=True)
        fits = np.flatnonzero(np.asarray(before)[a] >= skipped) if len(common) else []
        if not len(fits):
            return None
        total += int(before[a[fits[0]]]) - skipped
        skipped = int(next_before[b[fits[0]]])
    return total


def _cut(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            text = row["text"]
            for k, (begin, end) in enumerate(chunk_spans(len(text), chunk, overlap)):
                yield pa.RecordBatch.from_pylist([{
                    "key_id": row["key_id"], "key_text": row["key_text"], "n_chars": len(text), "k": k,
                    "begin": begin, "piece": text[begin:end]}], schema=_PIECES)
                if end == len(text):
                    break


_PIECES = pa.schema([("key_id", pa.int64()), ("key_text", pa.int64()), ("n_chars", pa.int64()),
                     ("k", pa.int64()), ("begin", pa.int64()), ("piece", pa.string())])
_ENCODED = "key_id long, key_text long, n_chars long, k long, end long, tokens long, positions array<long>, before array<long>"


def _encode_chunks(batches: Iterator[pa.RecordBatch], path: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    tokenizer, _ = load(path)
    for batch in batches:
        for row in batch.to_pylist():
            begin, piece = row["begin"], row["piece"]
            at, before, tokens = stable_boundaries(tokenizer, piece, 0, len(piece))
            shared = (at < overlap) | (at >= chunk)  # the zones this chunk shares with its neighbours
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (row["key_id"], row["key_text"], row["n_chars"], row["k"], begin + len(piece), tokens)]
                + [pa.array([(at[shared] + begin).tolist()], pa.list_(pa.int64())),
                   pa.array([before[shared].tolist()], pa.list_(pa.int64()))],
                names=["key_id", "key_text", "n_chars", "k", "end", "tokens", "positions", "before"])


def count_huge(docs: DataFrame, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``key_id, key_text, n_tokens`` of the texts of ``docs`` (those columns and ``text``).

    Chunks are rows of their own, so one document's chunks are encoded side by side. Documents
    in which some neighbours share no stable boundary go through again with four times the
    overlap; once an overlap reaches a text's end its first chunk holds the whole text.
    """
    import pandas as pd

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("k").sort_values("k")
        n = splice(list(zip(pdf["end"], pdf["tokens"], pdf["positions"], pdf["before"], strict=True)), int(pdf["n_chars"].iloc[0]))
        return pdf.iloc[:1][["key_id", "key_text"]].assign(n_tokens=-1 if n is None else n)

    # Encoding is work by characters, far more than the bytes suggest: a task for every 16 chunks.
    characters = docs.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-characters // (16 * chunk)))
    done, todo = None, docs
    while True:
        pieces = todo.mapInArrow(lambda it, c=chunk, o=overlap: _cut(it, c, o),
                                 "key_id long, key_text long, n_chars long, k long, begin long, piece string")
        encoded = (pieces.repartition(parts, "key_id", "key_text", "k")
                   .mapInArrow(lambda it, c=chunk, o=overlap: _encode_chunks(it, path, c, o), _ENCODED))
        counted = materialize(encoded.groupBy("key_id", "key_text").applyInPandas(join, "key_id long, key_text long, n_tokens long"),
                              "token-chunks")
        good = counted.where("n_tokens >= 0")
        done = good if done is None else done.unionByName(good)
        failed = counted.where("n_tokens < 0")
        if failed.isEmpty():
            return done
        overlap *= 4
        todo = docs.join(failed.select("key_id", "key_text"), ["key_id", "key_text"], "left_semi")


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048,
                 chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    Counts are those of the library on the whole text, without added special tokens; special
    strings inside a text count as the library has them. Null text is empty: 0 bytes, 0 tokens.
    Rows repeated in id and text get equal counts; null ids are kept; other columns are not
    read; an empty table gives no rows.
    """
    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(_word_counts(path, batch.column(1).to_pylist()))],
                names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    rows = df.select(df[id_col].cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = (rows.where(F.char_length("text") <= chunk).mapInArrow(small, "doc_id long, n_bytes long, n_tokens long"))
    huge = rows.where(F.char_length("text") > chunk).select("doc_id", "text", "n_bytes", *doc_key("doc_id", "text"))
    found = count_huge(huge.select("key_id", "key_text", "text").dropDuplicates(["key_id", "key_text"]), path, chunk, overlap)
    huge = huge.drop("text").join(found, ["key_id", "key_text"]).select("doc_id", "n_bytes", "n_tokens")
    return counted.unionByName(huge).withColumn("over_limit", F.col("n_tokens") > limit)
