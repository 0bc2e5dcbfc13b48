"""Quality rules from what public tokenisers make of a text.

Every whole text is measured once: counts of words, symbols, repeated lines and repeated windows, and
with two public vocabularies its characters per token, the share of tokens that are a lone byte (the
fallback of the piece vocabulary) and the entropy of its tokens. The measures of all documents that
pass the plain rules give bands per language (or per script, where a row has no language), for entropy also
per class of length: the quartiles, widened by a multiple of their distance. A document outside goes.

Texts are tokenised by their words, each distinct word of a few megabytes once.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentide.llm.arrow_text import EXACT, Words, slices, windows, words
from retentide.llm.spark_util import checkpoint

TOKENIZERS = "/opt/tokenizers"
PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the byte vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts tokenised at once, by bytes; the tokens whose counts are merged at once.
GROUP_BYTES, MERGE_TOKENS = 8 << 20, 1 << 21
#: Longer words are tokenised in pieces of so many characters, as merging takes more than linear time.
LONGEST_WORD = 256
WINDOW = 8
FEWEST_WORDS, MOST_REPEATED = 20, 30
#: A band reaches so many quartile distances beyond the quartiles, a distance counting as `least` at least.
WIDTH = 3.0
#: A band needs so many documents; else that of the next level counts, and without that none.
BAND_ROWS = 100
#: More bands than this aren't broadcast, as they would be if the language were a column of many values.
BROADCAST_BANDS = 20_000


@dataclass(frozen=True)
class Measure:
    name: str
    least: float  # the least quartile distance
    low: bool  # whether the band has a lower end
    high: bool
    levels: tuple[tuple[str, ...], ...]  # the rows that share a band; the first with enough documents counts


#: A language of few documents is judged by its script. Entropy grows with the length of a text, so its bands
#: are per class of length, too.
LEVELS = (("group",), ("script",), ("group", "length"), ("script", "length"))
MEASURES = (
    Measure("chars_per_piece", 0.2, True, True, LEVELS[:2]),
    Measure("chars_per_byte_token", 0.2, True, True, LEVELS[:2]),
    Measure("byte_share", 0.02, False, True, LEVELS[:2]),
    Measure("token_entropy", 0.25, True, False, LEVELS[2:]),
)

#: The scripts of characters, by the first byte of their UTF-8 form (first, last).
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9)),
    "greek": ((0xCE, 0xCF),),
    "cyrillic": ((0xD0, 0xD4),),
    "hebrew": ((0xD7, 0xD7),),
    "arabic": ((0xD8, 0xDD),),
    "brahmic": ((0xE0, 0xE0),),
    "cjk": ((0xE3, 0xE9),),
    "hangul": ((0xEA, 0xED),),
}
NAMES = np.array(["none", *SCRIPTS])
#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


def _byte_table(ranges: dict[int, tuple]) -> np.ndarray:
    table = np.zeros(256, np.int64)
    for value, spans in ranges.items():
        for first, last in spans:
            table[first : last + 1] = value
    return table


_SCRIPT = _byte_table({k: spans for k, spans in enumerate(SCRIPTS.values(), 1)})
_SYMBOL = _byte_table({1: tuple((b, b) for b in SYMBOLS)}).astype(bool)


@dataclass(frozen=True)
class Vocabularies:
    """The files of two public vocabularies, as sent to the tasks: two megabytes at most."""

    pieces: bytes
    ranks: bytes

    @classmethod
    def load(cls, folder: str = TOKENIZERS) -> Vocabularies:
        return cls((Path(folder) / PIECES).read_bytes(), (Path(folder) / BYTES).read_bytes())

    def __getstate__(self) -> dict:
        return {"pieces": self.pieces, "ranks": self.ranks}

    @cached_property
    def processor(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.pieces)

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
        return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def is_byte(self) -> np.ndarray:
        return np.array([self.processor.is_byte(k) for k in range(self.processor.get_piece_size())])

    def of_words(self, found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids of all words, their offsets by word, and the number of byte tokens of each."""
        parts, owner = found, None
        if any(len(w) > LONGEST_WORD for w in found):
            cut = [[w[k : k + LONGEST_WORD] for k in range(0, len(w), LONGEST_WORD)] for w in found]
            parts, owner = [p for pieces in cut for p in pieces], np.repeat(np.arange(len(found)), [len(p) for p in cut])
        ids = self.processor.encode(parts, num_threads=1)
        counts = np.fromiter(map(len, ids), np.int64, len(parts))
        encode = self.encoding.encode_ordinary
        tokens = np.fromiter((len(encode(" " + p)) for p in parts), np.int64, len(parts))
        if owner is not None:
            counts, tokens = (np.bincount(owner, x, len(found)).astype(np.int64) for x in (counts, tokens))
        flat = np.fromiter((k for one in ids for k in one), np.int32, int(counts.sum()))
        return flat, np.concatenate([[0], np.cumsum(counts)]), tokens


def _repeats(texts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which entries have the text and hash of an earlier one, and which of a later one."""
    order = np.lexsort((hashes, texts))
    same = (texts[order][1:] == texts[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    earlier, later = np.zeros(len(texts), bool), np.zeros(len(texts), bool)
    earlier[order[1:][same]] = True
    later[order[:-1][same]] = True
    return earlier, later


def repeated_words(w: Words, n: int) -> np.ndarray:
    """For each text the words inside windows that come up twice or more in it, the first time included."""
    hashes = windows(w.hashes, WINDOW)
    inside = np.flatnonzero(w.texts[: len(hashes)] == w.texts[WINDOW - 1 :]) if len(hashes) else np.empty(0, np.int64)
    earlier, later = _repeats(w.texts[inside], hashes[inside])
    starts = inside[earlier | later]
    steps = np.zeros(len(w.hashes) + 1, np.int64)
    steps[starts] += 1
    np.add.at(steps, starts + WINDOW, -1)
    return np.bincount(w.texts[np.cumsum(steps[:-1]) > 0], minlength=n)


def repeated_lines(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text the lines with a word that are equal to an earlier one."""
    lines = words(data, at, EXACT, inside=data != 0x0A)
    seen = np.concatenate([[0], np.cumsum(EXACT.is_word[data])])
    full = seen[lines.ends] > seen[lines.starts]
    earlier, _ = _repeats(lines.texts[full], lines.hashes[full])
    return np.bincount(lines.texts[full][earlier], minlength=len(at) - 1)


def token_entropy(texts: np.ndarray, inverse: np.ndarray, flat: np.ndarray, bounds: np.ndarray, n: int, size: int) -> np.ndarray:
    """Bits a token of each text, from the words' texts, their place among the distinct ones and those ones' tokens."""
    counts = np.diff(bounds)[inverse]
    ends = np.cumsum(counts)
    keys, totals, lo = np.empty(0, np.int64), np.empty(0, np.int64), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + MERGE_TOKENS, side="right")))
        c = counts[lo:hi]
        place = np.repeat(bounds[inverse[lo:hi]] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        new, times = np.unique(np.repeat(texts[lo:hi], c) * size + flat[place], return_counts=True)
        keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
        totals = np.bincount(back, np.concatenate([totals, times]), len(keys)).astype(np.int64)
        lo = hi
    whole = np.bincount(keys // size, totals, n)
    spread = np.bincount(keys // size, totals * np.log2(np.maximum(totals, 1)), n)
    few = np.maximum(whole, 1)
    return np.where(whole > 0, np.maximum(np.log2(few) - spread / few, 0), 0)


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_pieces long, n_byte_pieces long, n_byte_tokens long, token_entropy double, script string"


def measure_texts(data: np.ndarray, at: np.ndarray, vocabularies: Vocabularies) -> list[np.ndarray]:
    """The columns COLUMNS of a group of texts."""
    n = len(at) - 1
    w = words(data, at, EXACT)
    owner = np.repeat(np.arange(n), np.diff(at))
    inside = EXACT.is_word[data]
    chars = np.bincount(owner[inside & ((data & 0xC0) != 0x80)], minlength=n)
    scripts = np.bincount(owner * len(NAMES) + _SCRIPT[data], minlength=n * len(NAMES)).reshape(n, -1)
    scripts[:, 0] = 0
    _, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    found = [raw[a:b].decode() for a, b in zip(w.starts[first].tolist(), w.ends[first].tolist(), strict=True)]
    flat, bounds, tokens = vocabularies.of_words(found) if found else (np.empty(0, np.int32), np.zeros(1, np.int64), np.empty(0, np.int64))
    lone = np.concatenate([[0], np.cumsum(vocabularies.is_byte[flat])])
    per_text = lambda each: np.bincount(w.texts, each[inverse], n).astype(np.int64)
    return [
        np.bincount(w.texts, minlength=n),
        chars,
        np.bincount(owner[_SYMBOL[data]], minlength=n),
        repeated_lines(data, at),
        repeated_words(w, n),
        per_text(np.diff(bounds)),
        per_text(lone[bounds[1:]] - lone[bounds[:-1]]),
        per_text(tokens),
        token_entropy(w.texts, inverse, flat, bounds, n, len(vocabularies.is_byte)),
        NAMES[scripts.argmax(axis=1)],
    ]


def measure_documents(docs: DataFrame, vocabularies: Vocabularies, group: Column) -> DataFrame:
    """(doc_id, group, the columns COLUMNS) for each row of `docs`; NULL texts are empty."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies)
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, at in slices(batch.column("text"), GROUP_BYTES):
                rows = batch.slice(first, last - first)
                columns = [pa.array(x, pa.int64() if x.dtype.kind == "i" else None) for x in measure_texts(data, at, shared.value)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("group"), *columns], ["doc_id", "group", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), group.cast("string").alias("group"), F.col("text"))
    found = rows.mapInArrow(scan, f"doc_id long, group string, {COLUMNS}")
    per = lambda x, y: F.coalesce(F.try_divide(F.col(x), F.col(y)), F.lit(0.0))
    return found.withColumns(
        {
            "group": F.coalesce("group", F.concat(F.lit("script "), "script")),
            "length": F.floor(F.log2(F.greatest("n_words", F.lit(1)))).cast("int"),
            "chars_per_piece": per("word_chars", "n_pieces"),
            "chars_per_byte_token": per("word_chars", "n_byte_tokens"),
            "byte_share": per("n_byte_pieces", "n_pieces"),
            "base_failed": (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        }
    )


def _level(keys: tuple[str, ...]) -> Column:
    """A name of the rows that share a band of this level."""
    return F.concat_ws("\t", F.lit(",".join(keys)), *[F.col(k).cast("string") for k in keys])


def fit_bands(measured: DataFrame) -> DataFrame:
    """(level, band): for each level of rows that has enough documents an array of (low, high), one for each of MEASURES."""
    quartiles = [F.percentile_approx(m.name, F.array(F.lit(0.25), F.lit(0.75))).alias(m.name) for m in MEASURES]
    sound = measured.where("NOT base_failed").withColumn("level", F.explode(F.array(*map(_level, LEVELS))))
    found = sound.groupBy("level").agg(F.count("*").alias("n"), *quartiles).where(F.col("n") >= BAND_ROWS)
    ends = []
    for m in MEASURES:
        low, high = F.col(m.name)[0], F.col(m.name)[1]
        reach = WIDTH * F.greatest(high - low, F.lit(m.least))
        ends.append(F.struct((low - reach if m.low else F.lit(-math.inf)).alias("low"), (high + reach if m.high else F.lit(math.inf)).alias("high")))
    return found.select("level", F.array(*ends).alias("band"))


def judge(measured: DataFrame, bands: DataFrame) -> DataFrame:
    """`measured` with `kept` and the measures that are `outside` of their band. Bands are a few for each language, so
    they are broadcast; should a column with many values have been given for the language, they are joined."""
    bands = F.broadcast(bands) if bands.count() <= BROADCAST_BANDS else bands
    rows = measured
    for k, keys in enumerate(LEVELS):
        rows = rows.withColumn("level", _level(keys)).join(bands.withColumnRenamed("band", f"band{k}"), "level", "left")
    wrong = []
    for i, m in enumerate(MEASURES):
        band = F.coalesce(*[F.col(f"band{LEVELS.index(keys)}")[i] for keys in m.levels])
        wrong.append(F.when(~F.col(m.name).between(band["low"], band["high"]), F.lit(m.name)))
    rows = rows.withColumn("outside", F.array_compact(F.array(*wrong)))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))


def apply_rules(docs: DataFrame, folder: str = TOKENIZERS, language: Column | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, group, script, the
    measures, outside) for each row of `docs` (doc_id, text, ...).

    `folder` holds the vocabulary files; `language` names a row's language, else bands are per script. Words are runs
    without ASCII white space. NULL and empty texts have no words, so they fail the plain rules and are not kept; a
    document that is there twice is judged (and counts for the bands) twice; a NULL doc_id is kept as such. Texts are
    measured whole; only words beyond LONGEST_WORD characters are tokenised piece by piece. A value on the end of a
    band is inside. An empty table gives no rows; other columns, whatever their names, are ignored."""
    measured = checkpoint(measure_documents(docs, Vocabularies.load(folder), language if language is not None else F.lit(None)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "group", "script"]
    return judge(measured, checkpoint(fit_bands(measured))).select("doc_id", *names, *[m.name for m in MEASURES], "outside")
