"""Language identification by cross-parsing entropy.

For each language the suffix automaton of labelled text is built. A text is parsed against it
into phrases, each the longest match from where the last one ended; the language that needs
the fewest phrases, normalised by the size of its training text, wins. The automaton is laid
out as a table of transitions that goes back to its root where a phrase ends, so that many
pieces of text are parsed in lockstep.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import slices

UNKNOWN = "und"
#: Bounds of the fit: characters of training text per language, and of one document in it.
TRAIN_CHARS = 40_000
EXCERPT_CHARS = 2_000
#: Texts are parsed in blocks of this many symbols; a phrase ends where its block does.
BLOCK = 512

_MODELS: dict[str, Model] = {}


def symbols(text: str) -> np.ndarray:
    """Code points after lower-casing, with every run of other characters than letters and
    marks as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = _letter_table()[points]
    points = np.where(letters, points, 32)
    return points[letters | np.r_[True, letters[:-1]]] if len(points) else points


_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _LETTERS:
        import unicodedata
        _LETTERS.append(np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)], dtype=bool))
    return _LETTERS[0]


def suffix_automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton that accepts every substring of the sequence."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sequence:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return edges


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Model:
    """One automaton per language with letters in its sample, as tables over a common alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(lang for lang, sample in samples.items() if _has_letter(sample))
        parts = {lang: symbols(samples[lang]) for lang in self.languages}
        alphabet = np.unique(np.concatenate([np.array([32], dtype=np.uint32), *parts.values()]))
        self.classes = np.zeros(0x110000, dtype=np.uint16)  # class 0: never seen in training
        self.classes[alphabet] = np.arange(1, len(alphabet) + 1)
        self.width = len(alphabet) + 1
        # A symbol that a language never saw is spelled out in the common alphabet, so that a language of a
        # few symbols, whose phrases cost few bits, does not describe foreign text as a run of them.
        spelled = math.log2(self.width)
        self.tables, self.bits, self.more_if_unknown, self.seen = [], [], [], []
        for lang in self.languages:
            edges = suffix_automaton(self.classes[parts[lang]].tolist())
            # Entry: next state times width, and in the lowest bit whether a phrase ends before the
            # symbol. A symbol the root does not know is a phrase of its own: it leads to one more
            # state, from which every symbol starts a phrase.
            after_unknown = len(edges) * self.width * 2
            root = np.full(self.width, after_unknown, dtype=np.int64)
            root[list(edges[0])] = np.array(list(edges[0].values()), dtype=np.int64) * self.width * 2
            table = np.tile(root + 1, (len(edges) + 1, 1))
            table[0] = root
            for state, out in enumerate(edges):
                for c, to in out.items():
                    table[state, c] = to * self.width * 2
            if table.max() < 1 << 31:
                table = table.astype(np.int32)
            self.tables.append(table.ravel())
            self.bits.append(math.log2(max(2, len(parts[lang]))))
            self.more_if_unknown.append(max(0.0, spelled - self.bits[-1]))
            seen = np.zeros(self.width, dtype=bool)
            seen[list(edges[0])] = True
            self.seen.append(seen)

    def phrases(self, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases per (piece, language). ``classes``: positions by pieces, padded; a phrase
        also ends at the end of its piece."""
        order = np.argsort(-lengths, kind="stable")
        classes, sorted_lengths = np.ascontiguousarray(classes[:, order]), lengths[order]
        alive = np.searchsorted(-sorted_lengths, -np.arange(len(classes)), side="left")
        out = np.zeros((len(lengths), len(self.tables)), dtype=np.int64)
        for k, table in enumerate(self.tables):
            state = np.zeros(len(lengths), dtype=table.dtype)
            ended = np.zeros(len(lengths), dtype=np.int32)
            for i, n in enumerate(alive.tolist()):
                if n == 0:
                    break
                step = table[state[:n] + classes[i, :n]]
                ended[:n] += step & 1
                state[:n] = step >> 1
            out[order, k] = ended + (sorted_lengths > 0)
        return out

    def rates(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(bits per symbol for each text and language, whether the text has a letter)."""
        coded = [self.classes[symbols(t)] if t else np.zeros(0, np.uint16) for t in texts]
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        has_letter = np.array([_has_letter(t) for t in texts], dtype=bool)
        pieces = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), pieces)
        total = np.zeros((len(texts), len(self.languages)))
        if len(owner):
            flat = np.zeros(int(pieces.sum()) * BLOCK, dtype=np.uint16)
            first = np.cumsum(pieces) - pieces
            for f, c in zip(first.tolist(), coded, strict=True):
                flat[f * BLOCK:f * BLOCK + len(c)] = c
            place = np.arange(len(owner)) - first[owner]
            lengths = np.minimum(BLOCK, sizes[owner] - place * BLOCK)
            np.add.at(total, owner, self.phrases(flat.reshape(-1, BLOCK).T, lengths))
        bits = total * np.array(self.bits)
        for k in np.flatnonzero(self.more_if_unknown):  # languages of few training symbols only
            unknown = np.array([np.count_nonzero(~self.seen[k][c]) for c in coded])
            bits[:, k] += unknown * self.more_if_unknown[k]
        return bits / np.maximum(sizes, 1)[:, None], has_letter


def _model(samples: dict[str, str]) -> Model:
    key = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(samples)
    return _MODELS[key]


def training_samples(df: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str,
                     train_chars: int = TRAIN_CHARS, seed: int = 2) -> dict[str, str]:
    """For each language about ``train_chars`` characters: excerpts of at most ``EXCERPT_CHARS``
    from its labelled documents in seeded order, taken from a seeded place. The documents are
    chosen on their ids alone, about four times as many as full excerpts would need (all, if there
    are fewer), so their list is bounded by the languages and broadcast."""

    wanted = max(1, 4 * train_chars // EXCERPT_CHARS)
    labelled = (df.where(train & df[lang_col].isNotNull() & df[text_col].isNotNull())
                .select(df[id_col].cast("long").alias("of"), df[lang_col].alias("its_lang"), df[text_col].cast("string").alias("text")))
    keys = labelled.select(F.col("of").alias("id"), F.col("its_lang").alias("lang"))
    # A threshold on the hash of the id by language, from its count: no ranking of all rows. The
    # counts are one row per language, of which the driver holds a whole sample anyway.
    steps = 1 << 30
    counts = {r["lang"]: r["count"] for r in keys.groupBy("lang").count().collect()}
    if not counts:
        return {}
    limits = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(steps, steps * wanted // n))])
    chosen = (keys.withColumn("rank", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(steps)))
              .where(F.col("rank") < F.element_at(limits, F.col("lang"))).distinct())
    place = F.pmod(F.xxhash64(F.lit(seed + 1), "of"),
                   F.greatest(F.lit(1), F.char_length("text") - EXCERPT_CHARS)).cast("int") + 1
    excerpts = (labelled.join(F.broadcast(chosen), F.col("of").eqNullSafe(F.col("id")) & (F.col("its_lang") == F.col("lang")))
                .select("lang", "rank", F.substr(F.col("text"), place, F.lit(EXCERPT_CHARS)).alias("excerpt"))
                .groupBy("lang", "rank").agg(F.min("excerpt").alias("excerpt")))  # one of repeated rows
    samples: dict[str, list[str]] = {}
    for row in excerpts.orderBy("lang", "rank").collect():
        samples.setdefault(row.lang, [])
        if sum(map(len, samples[row.lang])) < train_chars:
            samples[row.lang].append(row.excerpt)
    return {lang: "\n".join(parts) for lang, parts in samples.items()}


def identify(df: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score, bits_per_symbol``.

    ``lang_pred`` is the language of ``samples`` with the fewest normalised phrases (ties: the
    first by name), ``und`` for null texts, texts without letters, or no samples at all. A label
    whose sample has no letter is never predicted.
    ``score`` is its share of the inverse phrase rates, 0 for ``und``. Whole texts are parsed.
    Repeated rows and null ids keep one row each; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(samples) if any(map(_has_letter, samples.values())) else None
        for batch in slices(batches, max_bytes=1 << 20):
            n = batch.num_rows
            langs, scores, rates = [UNKNOWN] * n, np.zeros(n), np.zeros(n)
            if model:
                bits, known = model.rates(batch.column(1).to_pylist())
                best = bits.argmin(1)
                rates = bits[np.arange(n), best]
                inverse = 1 / np.maximum(bits, 1e-9)
                scores = np.where(known, inverse[np.arange(n), best] / inverse.sum(1), 0.0)
                langs = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores), pa.array(rates)],
                                             names=["doc_id", "lang_pred", "score", "bits_per_symbol"])

    return (df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double, bits_per_symbol double"))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
