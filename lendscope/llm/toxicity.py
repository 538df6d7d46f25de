"""Toxicity by a linear-chain conditional random field over tokens.

The labels mark documents, so token labels are derived first: in a toxic document a token is
labelled toxic if one of its features (the word, or its first 4, 5 or 6 bytes) is tied to toxic
documents far beyond chance. The field is trained on these labelled tokens. Forward and backward
passes give each token's marginal; the marginals of a whole document are summed up by a
logistic layer fitted on the training documents, and runs of toxic tokens are its offending
offsets. All passes run over many segments in lockstep.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import SpanHasher, mix64, slices, text_buffer, word_spans

#: Bounds of the fit: documents per label, bytes of one document, and those for the chain.
FIT_DOCS = 1500
FIT_EXCERPT = 5000
CHAIN_DOCS = 600
PREFIXES = (4, 5, 6)
SEGMENT = 64  # tokens of one chain; a longer document is several chains

_SEPARATES = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of the Latin-1 block in lower case, length unchanged."""
    out = _LOWER[raw]
    capital = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    out[1:][capital] += 0x20
    return out


def token_features(raw: np.ndarray, offsets: np.ndarray):
    """(feature hashes by token, starts, ends, first token of each text). Tokens are runs of
    letters, digits and non-ASCII bytes."""
    low = lower_bytes(raw) if len(raw) else raw
    starts, ends, first = word_spans(low, offsets, _SEPARATES)
    hasher = SpanHasher(low)
    columns = [hasher(starts, ends)]
    for k in PREFIXES:  # the prefix length is mixed in; shorter words repeat the whole word
        columns.append(mix64(hasher(starts, np.minimum(starts + k, ends)) + np.uint64(k)))
    return np.stack(columns, 1), starts, ends, first


@dataclass
class Field:
    """A trained field: sorted feature hashes with weights, bias, transition matrix in logs and
    the document layer (weights of the largest marginal's logit and of the toxic token count)."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float = -6.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    layer: tuple[float, float, float] = (0.0, 1.0, 0.0)

    def __post_init__(self):
        self.passes = np.zeros(1 << 22, dtype=bool)
        self.passes[(self.hashes >> np.uint64(42)).astype(np.int64)] = True

    def lookup(self, features: np.ndarray) -> np.ndarray:
        """Index of each feature in ``hashes``, or -1."""
        flat = features.ravel()
        found = np.full(len(flat), -1, dtype=np.int64)
        maybe = np.flatnonzero(self.passes[(flat >> np.uint64(42)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, flat[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == flat[maybe]
            found[maybe[same]] = at[same]
        return found.reshape(features.shape)

    def emissions(self, known: np.ndarray) -> np.ndarray:
        padded = np.append(self.weights, 0.0)
        return padded[known].sum(1) + self.bias

    def marginals(self, emissions: np.ndarray, segments: tuple) -> np.ndarray:
        """Log-odds of the toxic label of every token."""
        grid, lengths, where = _to_grid(emissions, segments)
        ahead, back = self.passes_over(grid, lengths)
        return (ahead + back)[where]

    def passes_over(self, grid: np.ndarray, lengths: np.ndarray):
        """Forward and backward log-odds by (position, segment). With two labels each message is
        one number, the log-odds of its two entries."""
        (t00, t01), (t10, t11) = np.exp(self.moves)
        ahead = np.empty_like(grid)
        ahead[0] = grid[0] + self.moves[0, 1] - self.moves[0, 0]  # as if a clean token came before
        for i in range(1, len(grid)):
            odds = np.exp(np.clip(ahead[i - 1], -60, 60))
            ahead[i] = grid[i] + np.log((t01 + t11 * odds) / (t00 + t10 * odds))
        back = np.zeros_like(grid)
        for i in range(len(grid) - 2, -1, -1):
            odds = np.exp(np.clip(grid[i + 1] + back[i + 1], -60, 60))
            back[i] = np.where(i + 1 < lengths, np.log((t10 + t11 * odds) / (t00 + t01 * odds)), 0.0)
        return ahead, back


def segments_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment of each token, place in it): runs of at most ``SEGMENT`` tokens of one text."""
    counts = np.diff(first)
    place = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    pieces = -(-counts // SEGMENT)
    base = np.cumsum(pieces) - pieces
    return np.repeat(base, counts) + place // SEGMENT, place % SEGMENT


def _to_grid(values: np.ndarray, segments: tuple):
    segment, place = segments
    n = int(segment[-1]) + 1 if len(segment) else 0
    grid = np.zeros((SEGMENT, n))
    grid[place, segment] = values
    return grid, np.bincount(segment, minlength=n), (place, segment)


# --- training ---------------------------------------------------------------------------------------

def fit(texts: list[str], toxic: list[int], rounds: int = 30, rate: float = 0.5) -> Field | None:
    """Train on whole documents with document labels; None if only one label occurs."""
    labels = np.array(toxic, dtype=bool)
    if labels.all() or not labels.any():
        return None
    parts, counts = [], [np.zeros(1, dtype=np.int64)]
    for at in range(0, len(texts), 256):  # the working arrays are many times the text
        features, _, _, first = token_features(*text_buffer(pa.array(texts[at:at + 256], pa.string())))
        parts.append(features)
        counts.append(np.diff(first))
    features, first = np.concatenate(parts), np.cumsum(np.concatenate(counts))
    del parts
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))
    names, codes, size = [], np.empty(features.shape, dtype=np.int32), 0
    for c in range(features.shape[1]):  # the kinds of feature share no hashes
        found, code = np.unique(features[:, c], return_inverse=True)
        codes[:, c] = code + size
        size += len(found)
        names.append(found)
    hashes = np.concatenate(names)
    group = _copy_groups(features[:, 0], first)
    # Features are tied to toxic documents in rounds, each on those no feature explains yet.
    tied, in_any, open_toxic = np.zeros(size, dtype=bool), None, labels.copy()
    for _ in range(4):
        in_toxic, in_clean, share = _document_counts(codes, owner, group, size, open_toxic, ~labels)
        if in_any is None:
            in_any = in_toxic + in_clean
        new = _beyond_chance(in_toxic, in_clean, share) & ~tied
        if not new.any():
            break
        tied |= new
        explained = np.zeros(len(texts), dtype=bool)
        explained[owner[tied[codes].any(1)]] = True
        open_toxic = labels & ~explained
        if not open_toxic.any():
            break
    token_label = tied[codes].any(1) & labels[owner]
    # The chain learns from a bounded part of the documents, with features seen twice or tied.
    chosen = np.zeros(len(texts), dtype=bool)
    for side in (labels, ~labels):
        chosen[np.flatnonzero(side)[:CHAIN_DOCS]] = True
    keep = (in_any >= 3) | tied
    position = np.cumsum(keep) - 1
    rows = chosen[owner]
    known = np.where(keep[codes[rows]], position[codes[rows]], -1).astype(np.int32)
    order = np.argsort(hashes[keep], kind="stable")
    known = np.append(np.argsort(order, kind="stable"), -1).astype(np.int32)[known]
    model = Field(hashes[keep][order], np.zeros(len(order)))
    del codes, hashes, names, position, order
    sub_first = np.r_[0, np.cumsum(np.bincount(owner[rows], minlength=len(texts)))]
    _train_chain(model, known, token_label[rows], segments_of(sub_first), rounds, rate)
    strong = np.abs(model.weights) > 0.05
    model = Field(model.hashes[strong], model.weights[strong], model.bias, model.moves)
    model.layer = _fit_layer(*model_document_values(model, features, first), labels)
    return model


def _document_counts(codes, owner, group, size, toxic, clean):
    """Groups of toxic and of clean documents that hold each feature, and the share of toxic ones."""
    counts = []
    for side in (toxic, clean):
        rows = side[owner]
        of = group[owner[rows]].astype(np.int64)
        count = np.zeros(size, dtype=np.int64)
        for c in range(codes.shape[1]):
            pair = np.unique(codes[rows, c] * np.int64(len(group)) + of)
            count += np.bincount(pair // len(group), minlength=size)
        counts.append(count)
    n_toxic, n_clean = len(np.unique(group[toxic])), len(np.unique(group[clean]))
    return *counts, n_toxic / max(1, n_toxic + n_clean)


def _beyond_chance(in_toxic, in_clean, share):
    """Features almost only in toxic documents whose counts no feature would reach by luck: the
    exponential of minus the log-likelihood ratio bounds the chance of one feature's counts."""
    total = np.maximum(in_toxic + in_clean, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = (np.where(in_toxic > 0, in_toxic * np.log(in_toxic / (total * share)), 0.0)
                    + np.where(in_clean > 0, in_clean * np.log(in_clean / (total * (1 - share))), 0.0))
    return (surprise > math.log(max(2, (in_toxic >= 2).sum())) + 1) & (in_toxic > 0.9 * total)


def _copy_groups(words: np.ndarray, first: np.ndarray, rounds: int = 64, alike: float = 0.8) -> np.ndarray:
    """The group of each document, named by its first member: a document joins the group whose
    first member agrees with it in most of the smallest hashes of their runs of four words, if
    that share (an estimate of the share of runs they have in common) is at least ``alike``."""
    counts = np.diff(first)
    left = np.repeat(first[1:], counts) - np.arange(len(words))  # words up to the document's end
    runs = np.zeros(len(words), dtype=np.uint64)
    for k in range(3, -1, -1):
        moved = np.append(words[k:], np.zeros(min(k, len(words)), dtype=np.uint64))
        runs = mix64(np.where(left > k, moved, np.uint64(0)) + runs)
    group = np.arange(len(counts))
    some = np.flatnonzero(counts)
    if not len(some):
        return group
    least = np.stack([np.minimum.reduceat(mix64(runs + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))), first[some])
                      for k in range(rounds)], 1)
    leads, n_leads = np.empty_like(least), 0
    names = np.empty(len(some), dtype=np.int64)
    for doc, signature in zip(some, least, strict=True):
        same = (leads[:n_leads] == signature).sum(1)
        best = int(same.argmax()) if n_leads else -1
        if n_leads and same[best] >= alike * rounds:
            group[doc] = names[best]
        else:
            leads[n_leads], names[n_leads] = signature, doc
            n_leads += 1
    return group


def _train_chain(model: Field, known, labels, segments, rounds, rate):
    """Adaptive gradient ascent on the conditional likelihood of the token labels."""
    _, lengths, where = _to_grid(np.zeros(len(labels)), segments)
    grid_label = np.zeros((SEGMENT, len(lengths)), dtype=bool)
    grid_label[where] = labels
    inner = np.arange(1, SEGMENT)[:, None] < lengths[None, :]
    before, after = grid_label[:-1], grid_label[1:]
    seen = np.array([[((before == a) & (after == b) & inner).sum() for b in (0, 1)] for a in (0, 1)], dtype=float)
    seen[0] += [(~grid_label[0]).sum(), grid_label[0].sum()]
    valid = known >= 0
    flat, token_of = known[valid], np.nonzero(valid)[0].astype(np.int32)
    del valid
    squares, square_b, square_m = np.full(len(model.weights), 1e-6), 1e-6, np.full((2, 2), 1e-6)
    for _ in range(rounds):
        emissions = model.emissions(known)
        grid, _, _ = _to_grid(emissions, segments)
        ahead, back = model.passes_over(grid, lengths)
        odds = np.clip((ahead + back)[where], -60, 60)
        error = labels - 1 / (1 + np.exp(-odds))
        slope = np.bincount(flat, weights=error[token_of], minlength=len(model.weights)) - 0.01 * model.weights
        squares += slope ** 2
        model.weights = model.weights + rate * slope / np.sqrt(squares)
        slope_b = error.sum()
        square_b += slope_b ** 2
        model.bias += rate * slope_b / math.sqrt(square_b)
        move = np.exp(model.moves)
        left = [np.ones_like(grid[1:]), np.exp(np.clip(ahead[:-1], -60, 60))]
        right = [np.ones_like(grid[1:]), np.exp(np.clip(grid[1:] + back[1:], -60, 60))]
        total = sum(left[a] * move[a, b] * right[b] for a in (0, 1) for b in (0, 1))
        wanted = np.array([[(left[a] * move[a, b] * right[b] / total)[inner].sum() for b in (0, 1)] for a in (0, 1)])
        start = 1 / (1 + np.exp(-np.clip(ahead[0] + back[0], -60, 60)))
        wanted[0] += [(1 - start).sum(), start.sum()]
        slope_m = seen - wanted - 0.01 * model.moves
        square_m += slope_m ** 2
        model.moves = model.moves + rate * 0.2 * slope_m / np.sqrt(square_m)


def model_document_values(model: Field, features, first):
    """Per document: logit of the largest marginal (-12 without tokens) and the log of one plus
    the expected number of toxic tokens among those likelier toxic than not; and all logits."""
    n = len(first) - 1
    logits = model.marginals(model.emissions(model.lookup(features)), segments_of(first)) if first[-1] else np.zeros(0)
    top, toxic = np.full(n, -12.0), np.zeros(n)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        top[some] = np.clip(np.maximum.reduceat(logits, first[some]), -12, 12)
        probability = 1 / (1 + np.exp(-np.clip(logits, -60, 60)))
        toxic[some] = np.add.reduceat(np.where(logits > 0, probability, 0.0), first[some])
    return top, np.log1p(toxic), logits


def _fit_layer(top, toxic, _, labels, rounds: int = 500):
    """Logistic regression on the two document values by gradient descent, labels weighing alike."""
    x = np.stack([np.ones(len(top)), top / 4, toxic], 1)
    weight = np.where(labels, 0.5 / labels.sum(), 0.5 / (~labels).sum())
    w = np.array([0.0, 1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w += 2.0 * (x.T @ (weight * (labels - p)) - 0.001 * w * [0, 1, 1])
    return float(w[0]), float(w[1]) / 4, float(w[2])


def training_documents(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                       label_col: str = "toxic", fit_docs: int = FIT_DOCS, seed: int = 3) -> tuple[list[str], list[int]]:
    """Texts and labels of about ``fit_docs`` documents per label (all, if there are fewer), chosen by
    a hash of their ids (a bounded list of ids, so it is broadcast), each at most ``FIT_EXCERPT`` characters from a
    seeded place. ``train`` is a condition on the label rows."""
    marked = (labels.where(train & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label")))
    ids = marked.groupBy("id").agg(F.max("label").alias("label"))
    # A threshold on the hash for each label, from its count: no ranking of all labelled rows.
    counts = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    steps = 1 << 30
    limit = F.lit(0)
    for label, n in counts.items():
        limit = F.when(F.col("label") == label, F.lit(min(steps, steps * fit_docs // n))).otherwise(limit)
    ids = ids.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(steps)) < limit)
    # The same share of the length for texts that begin alike, so that copies have like excerpts.
    share = F.pmod(F.xxhash64(F.lit(seed), F.substr(F.col("text"), F.lit(1), F.lit(64))), F.lit(steps)) / steps
    place = F.floor(share * F.greatest(F.lit(1), F.char_length("text") - FIT_EXCERPT)).cast("int") + 1
    rows = (docs.select(docs[id_col].cast("long").alias("of"), docs[text_col].cast("string").alias("text"))
            .join(F.broadcast(ids), F.col("of") == F.col("id"))
            .groupBy("id", "label").agg(F.min(F.substr(F.coalesce(F.col("text"), F.lit("")), place, F.lit(FIT_EXCERPT))).alias("excerpt"))
            .orderBy(F.xxhash64(F.lit(seed + 1), "id")).collect())
    return [r.excerpt for r in rows], [int(r.label) for r in rows]


def score_texts(texts: pa.Array, model: Field | None) -> tuple[np.ndarray, list[list[dict]]]:
    """(score, spans) of each text; see ``score``."""
    scores, spans = np.zeros(len(texts)), [[] for _ in range(len(texts))]
    if model is None:
        return scores, spans
    raw, offsets = text_buffer(texts)
    features, starts, ends, first = token_features(raw, offsets)
    top, toxic, logits = model_document_values(model, features, first)
    bias, w_top, w_toxic = model.layer
    scores = 1 / (1 + np.exp(-(bias + w_top * top + w_toxic * toxic)))
    hit = np.flatnonzero(logits > 0)
    if len(hit):
        owner = np.searchsorted(first, hit, side="right") - 1
        chars = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
        edge = np.flatnonzero(np.r_[True, (np.diff(hit) > 1) | (np.diff(owner) > 0)])
        last = np.r_[edge[1:], len(hit)] - 1
        for doc, b, e in zip(owner[edge].tolist(), starts[hit[edge]].tolist(), ends[hit[last]].tolist(), strict=True):
            spans[doc].append({"start": int(chars[b] - chars[offsets[doc]]), "length": int(chars[e] - chars[b])})
    return scores, spans


def reject(df: DataFrame, model: Field | None, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with all their columns, whatever their names.
    Null and empty texts stay unless the model finds a text without toxic tokens toxic; whole texts
    are scored, however long; repeated rows fare alike; an empty table gives no rows."""
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            scores, _ = score_texts(batch.column(place), model)
            yield batch.filter(pa.array(scores < 0.5))

    return df.mapInArrow(run, df.schema)


def score(df: DataFrame, model: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score, predicted, spans``.

    ``score`` is the probability that the whole text is toxic, ``predicted`` 1 from 0.5 on, and
    ``spans`` the runs of neighbouring toxic tokens as (start, length) in code points. Null and
    empty texts have no tokens and get the score of a document without toxic tokens. Without a
    model (no labels, or one label only) every score is 0. Repeated rows and null ids keep one
    row each; an empty table gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores, spans = score_texts(batch.column(1), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                                              pa.array(spans, schema.field("spans").type)], schema=schema)

    return (df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int, spans array<struct<start:int,length:int>>"))
