"""Language identification by Viterbi over per-word scores.

Every word gets a score for each language: log probabilities of its letter trigrams (with word borders) and of the
whole word, learned by counting. The script of a word narrows the candidates to the languages that use it. Per-word
scores are bounded, so one odd word decides nothing, and changing the language between two words costs
`PENALTY`. The best path labels spans of a mixed text; the language with the most letters is that of the text, and its
share of the letters the score.

No letters (also null and empty): `und`, score 0. Words of a script that no learned language uses speak for
none. Without any learned language everything is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardenlake.llm import pretokens
from wardenlake.llm.batches import sampled

TRAIN_ROWS = 20_000
TABLE_BITS = 16
PENALTY = 6.0
MOST_A_WORD = 6.0
PIECE = 128
SCRIPT_SHARE = 0.01
LEAST_SHARE = 0.5
UNKNOWN = "und"

# First code points of ranges with one script each; what is between two entries has the first one's.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB07, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF60, "kana"),
    (0xFFA0, "other"), (0x20000, "han"), (0x30000, "other"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})


def script_numbers(points: np.ndarray) -> np.ndarray:
    starts = np.array([s for s, _ in SCRIPT_STARTS], np.uint32)
    names = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS], np.int8)
    return names[np.searchsorted(starts, points, side="right") - 1]


@dataclass
class Words:
    """The words of some texts: lower-cased runs of letters, as positions in an array of code points."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, and past the last
    trigrams: np.ndarray  # the table row of each letter, words one after the other
    whole: np.ndarray  # the table row of each word
    scripts: np.ndarray

    @property
    def letters(self) -> np.ndarray:
        return self.ends - self.starts


def split_words(texts: list[str]) -> Words:
    lowered = [t.lower() for t in texts]
    _, points, text_ends = pretokens.code_points(lowered)
    letter = pretokens.char_classes()[points] == pretokens.LETTER
    letter[text_ends] = False
    change = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    starts, ends = change[::2], change[1::2]
    # letters only, a 0 before and behind every word
    kept = np.where(letter, points, 0).astype(np.uint32)
    before = np.concatenate([[0], kept[:-1]]).astype(np.uint32)
    after = np.concatenate([kept[1:], [0]]).astype(np.uint32)
    mixed = (before * np.uint32(0x9E3779B1)) ^ (kept * np.uint32(0x85EBCA77)) ^ (after * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    rows = (mixed * np.uint32(0x27D4EB2F) >> np.uint32(32 - TABLE_BITS)).astype(np.int32)
    whole = (pretokens.span_hashes(points, starts, ends) >> np.uint64(64 - TABLE_BITS)).astype(np.int64) + (1 << TABLE_BITS)
    first = np.concatenate([[0], np.searchsorted(starts, text_ends)])
    return Words(starts, ends, first, rows[letter], whole, script_numbers(points[starts]))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (2 << TABLE_BITS, languages): log probabilities, those of trigrams first
    scripts: np.ndarray  # (scripts, languages): may a word of the script be in the language

    def emissions(self, words: Words) -> np.ndarray:
        """(words, languages): how far each word is from its best language, at most MOST_A_WORD."""
        n = len(words.starts)
        if not n:
            return np.zeros((0, len(self.languages)), np.float32)
        at = np.concatenate([[0], np.cumsum(words.letters)[:-1]])
        score = np.add.reduceat(self.table[words.trigrams], at, axis=0) + self.table[words.whole]
        allowed = self.scripts[words.scripts]
        known = allowed.any(axis=1, keepdims=True)
        score = np.where(allowed, score, -np.inf)
        best = np.where(known, score.max(axis=1, keepdims=True), 0)
        return np.where(known, np.maximum(score - best, -MOST_A_WORD), 0).astype(np.float32)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best label of every word: sum of scores less `penalty` for each change of label within a text.

    Texts fall into pieces of PIECE words. A first sweep finds, for all pieces at once, the best sum from every label
    before a piece to every label at its end; a second one picks the labels at the seams of each text; a third one
    traces the words of all pieces back.
    """
    n, labels = scores.shape
    sizes = np.diff(first)
    counts = -(-sizes // PIECE)
    pieces = int(counts.sum())
    if not pieces:
        return np.empty(0, np.int64)
    text = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(pieces) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[text] + number * PIECE
    size = np.minimum(PIECE, first[text + 1] - start)
    order = np.argsort(-size, kind="stable")
    text, number, start, size = text[order], number[order], start[order], size[order]
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size[0]))]  # pieces longer than t
    change = penalty * (1 - np.eye(labels, dtype=np.float32))

    best = np.zeros((pieces, labels, labels), np.float32)  # label before the piece, label now
    for t, k in enumerate(live):
        now = best[:k]
        stay = -change[None] if t == 0 else np.maximum(now, now.max(axis=2, keepdims=True) - penalty)
        best[:k] = stay + scores[start[:k] + t][:, None, :]

    # seams: pieces of a text in turn, all texts at once
    where = np.empty(pieces, np.int64)  # the place of a piece in text order
    slot = np.cumsum(counts) - counts
    where[slot[text] + number] = np.arange(pieces)
    total = np.zeros((len(sizes), labels), np.float32)
    came = np.zeros((pieces, labels), np.int64)
    for r in range(int(counts.max())):
        these = np.flatnonzero(counts > r)
        p = where[slot[these] + r]
        options = total[these][:, :, None] + best[p]
        came[p] = options.argmax(axis=1)
        total[these] = options.max(axis=1)
    into, out = np.zeros(pieces, np.int64), np.zeros(pieces, np.int64)
    label = total.argmax(axis=1)
    for r in range(int(counts.max()) - 1, -1, -1):
        these = np.flatnonzero(counts > r)
        p = where[slot[these] + r]
        out[p] = label[these]
        into[p] = came[p, label[these]]
        label[these] = into[p]

    # words, given the label before each piece
    now = np.zeros((pieces, labels), np.float32)
    step = np.zeros((len(live), pieces, labels), np.int8)
    every = np.arange(labels)
    for t, k in enumerate(live):
        if t == 0:
            now = scores[start] - change[into]
            step[0] = into[:, None]
            continue
        old = now[:k]
        top = old.argmax(axis=1)
        switched = old[np.arange(k), top][:, None] - penalty
        moved = switched > old
        step[t, :k] = np.where(moved, top[:, None], every[None])
        now[:k] = np.where(moved, switched, old) + scores[start[:k] + t]
    found = np.empty(n, np.int64)
    label = out.copy()
    for t in range(len(live) - 1, -1, -1):
        k = live[t]
        found[start[:k] + t] = label[:k]
        label[:k] = step[t, np.arange(k), label[:k]]
    return found


# ---------------------------------------------------------------------------------------------
# learning


def held_out(key: Column) -> Column:
    """Rows that nothing is learned from: a quarter, by the CRC-32 of the key as text. A null key isn't among them."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from about `rows` documents with a language, chosen by a hash of id and text; a held-out row is never used.

    Copies among them count once, so a text that a third of all rows share takes no more room than any other.
    """
    rest = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    picked = rest.where(sampled(rows, rest.count(), "doc_id", "text")).select("text", "lang").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist())
            for parts, owners in pretokens.pieces(texts):
                words = split_words(parts)
                owner = np.repeat(langs[owners], np.diff(words.first)) if len(words.starts) else np.empty(0, str)
                for lang in set(owner.tolist()):
                    mine = owner == lang
                    table = counts.setdefault(lang, np.zeros(2 << TABLE_BITS, np.int64))
                    table += np.bincount(words.trigrams[np.repeat(mine, words.letters)], minlength=2 << TABLE_BITS)
                    table += np.bincount(words.whole[mine], minlength=2 << TABLE_BITS)
                    use = scripts.setdefault(lang, np.zeros(len(SCRIPTS), np.int64))
                    use += np.bincount(words.scripts[mine], weights=words.letters[mine], minlength=len(SCRIPTS)).astype(np.int64)
        for lang, table in counts.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang], "counts": [table.astype("<i8").tobytes()], "scripts": [scripts[lang].astype("<i8").tobytes()]}
            )

    tasks = min(8, docs.sparkSession.sparkContext.defaultParallelism)
    found = picked.repartition(tasks).mapInArrow(count, "lang string, counts binary, scripts binary").collect()
    languages = sorted({r["lang"] for r in found})
    counts = np.zeros((2 << TABLE_BITS, len(languages)))
    scripts = np.zeros((len(SCRIPTS), len(languages)))
    for r in found:
        counts[:, languages.index(r["lang"])] += np.frombuffer(r["counts"], "<i8")
        scripts[:, languages.index(r["lang"])] += np.frombuffer(r["scripts"], "<i8")
    half, table = 1 << TABLE_BITS, np.zeros(counts.shape, np.float32)
    for part in (slice(0, half), slice(half, None)):
        some = counts[part] + 0.05
        table[part] = np.log(some / some.sum(axis=0))
    used = scripts / np.maximum(1, scripts.sum(axis=0)) >= SCRIPT_SHARE
    return Model(languages, table, used)


# ---------------------------------------------------------------------------------------------
# prediction


def _labelled(model: Model, texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray, Words, np.ndarray]]:
    for parts, owners in pretokens.pieces(texts):
        words = split_words(parts)
        yield parts, owners, words, viterbi(model.emissions(words), words.first)


def classify(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    letters = np.zeros((len(texts), max(1, len(model.languages))), np.int64)
    if model.languages:
        for _, owners, words, labels in _labelled(model, texts):
            np.add.at(letters, (np.repeat(owners, np.diff(words.first)), labels), words.letters)
    total = letters.sum(axis=1)
    top = letters.argmax(axis=1)
    score = letters[np.arange(len(texts)), top] / np.maximum(1, total)
    return [model.languages[t] if n else UNKNOWN for t, n in zip(top.tolist(), total.tolist())], score


def predicted(text: str | Column, model: Model) -> Column:
    """(lang, score) of a STRING column."""
    sent = _send(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            langs, score = classify(sent.value, batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score, pa.float64())], ["lang", "score"])

    return language(text)


def spans(text: str | Column, model: Model) -> Column:
    """The spans of one language each: array of (lang, words, text), the text from the first to the last letter."""
    sent = _send(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32()), ("text", pa.string())]))

    @F.arrow_udf("array<struct<lang: string, words: int, text: string>>")
    def labelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                found = []
                for parts, _, words, labels in _labelled(sent.value, [text]) if sent.value.languages else ():
                    source = "\n".join(parts)
                    source = source if len(source.lower()) == len(source) else source.lower()
                    cuts = np.flatnonzero(np.diff(labels, prepend=-1, append=-1)) if len(labels) else []
                    for s, e in zip(cuts[:-1], cuts[1:]):
                        part = source[words.starts[s] : words.ends[e - 1]]
                        found.append({"lang": sent.value.languages[labels[s]], "words": int(e - s), "text": part})
                out.append(found)
            yield pa.array(out, kind)

    return labelled(text)


def _send(model: Model):
    """The model has a fixed size for each language."""
    return SparkSession.active().sparkContext.broadcast(model)


def with_language(docs: DataFrame, least: float = LEAST_SHARE, rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents that have a language with at least `least` of their letters, as they are."""
    guess = predicted("text", train(docs, rows))
    marked = docs.withColumn("__guess", guess)
    return marked.where((F.col("__guess.lang") != UNKNOWN) & (F.col("__guess.score") >= least)).select(*docs.columns)


def predict_documents(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that aren't held out."""
    guess = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted("text", train(docs, rows)).alias("guess"))
    return guess.select("doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score"))
