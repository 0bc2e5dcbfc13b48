"""Benchmark decontamination by canonical templates.

Words are canonicalised: numbers, names and units after numbers become typed placeholders. Windows of
WINDOW canonical words of documents and benchmark items meet in a hash join. What stood in the slots
must agree: along one alignment, each value of the item has to stand for one value of the document, so
a question with other numbers or names is caught and a chance meeting of templates is not.

Four forms are compared. The plain form keeps names as words and so doesn't depend on capitals; the
named form, only for windows that have a name, replaces runs of capitalised words within sentences. The
verbatim form, for items with windows of little but placeholders, keeps all words, numbers too. The
opening form takes capitalised words that open sentences for names as well, unless they are words that
commonly do (OPENERS); it is for texts that have such a name and counts all their windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentide.llm.arrow_text import PLACES, WORDS, Words, letters_inside, mix, slices, text_buffer, windows, words
from retentide.llm.spark_util import bitmap, checkpoint, in_bitmap

WINDOW = 8
#: An item is in a document if so many percent of its windows are, or so many neighbouring words (windows + 7).
PERCENT, RUN_WINDOWS = 50, 13
#: The least share of an item's slots that must be filled consistently.
CONSISTENT = 0.8
#: A window needs this share of plain words.
LITERAL = 0.5
NAMED, VERBATIM, OPENING = 1, 2, 3
BITMAP_BITS = 24
SALTS = 8
#: Words that count as units after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces "
    "ml l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "hz khz mhz ghz b kb mb gb tb w kw v a ohm ohms j kj n pa c f k percent dollar dollars euro euros cent cents usd eur degree degrees"
).split()
#: Words that open sentences and aren't names.
OPENERS = (
    "a an the this that these those it its he she they we you i his her their our your my there here what which who whom whose when where why how "
    "is are was were am be been do does did has have had can could will would shall should may might must if then else while after before during since until unless although though because "
    "as so thus hence therefore however but and or nor yet not no in on at of for from by with without to into over under between among about each every all any some both either neither "
    "many most more few several one two three four five six seven eight nine ten first second third next last finally now later also only just suppose assume given let consider imagine "
    "find calculate compute determine evaluate solve simplify write give name list choose select complete continue fill answer explain describe state show prove use using convert estimate round "
    "read question options true false yes please today yesterday tomorrow once again another other"
).split()

_NUMBER, _NAME, _UNIT = mix(np.array([101, 102, 103], np.uint64))


def _word_hashes(of: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(of).encode(), np.uint8)
    return np.sort(words(data, np.array([0, len(data)]), WORDS).hashes)


def _canonical(data: np.ndarray, w: Words, units: np.ndarray) -> np.ndarray:
    """The hash of each word's canonical form in the plain form. A word that only goes on a number (the 000
    of 1,000) gets hash 0 and is left out by the callers."""
    n = len(w.hashes)
    digit = (data[w.starts] >= 48) & (data[w.starts] <= 57)
    out = np.where(digit, _NUMBER, w.hashes)
    if not n:
        return out
    follows = np.zeros(n, bool)
    follows[1:] = w.texts[1:] == w.texts[:-1]
    previous = np.zeros(n, bool)
    previous[1:] = digit[:-1]
    place = np.minimum(np.searchsorted(units, w.hashes), len(units) - 1)
    out = np.where(follows & previous & ~digit & (units[place] == w.hashes), _UNIT, out)
    one = np.zeros(n, bool)
    one[1:] = w.starts[1:] - w.ends[:-1] == 1
    before = data[np.maximum(w.starts - 1, 0)]
    out = np.where(follows & previous & digit & one & ((before == 44) | (before == 46)), np.uint64(0), out)
    return out


def _names(data: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Which words have a capital, and which begin a text, sentence or line."""
    n = len(w.hashes)
    follows = np.zeros(n, bool)
    follows[1:] = w.texts[1:] == w.texts[:-1]
    capital = (data[w.starts] >= 65) & (data[w.starts] <= 90)
    wide = np.flatnonzero((data[w.starts] == 0xC3) & (w.ends - w.starts > 1))
    second = data[w.starts[wide] + 1]
    capital[wide] = (second >= 0x80) & (second <= 0x9E)
    stops = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(b".!?:;\n\r", np.uint8)))])
    begins = np.ones(n, bool)
    begins[1:] = stops[w.starts[1:]] > stops[w.ends[:-1]]
    return capital, begins | ~follows


def _forms(lower: tuple[np.ndarray, np.ndarray], raw: tuple[np.ndarray, np.ndarray], units: np.ndarray, openers: np.ndarray, whole: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For the plain (0), the named (1), the opening (3) and the verbatim form (2): canonical hashes, texts, first and last bytes in the
    lower-cased text. Capitals are those of the raw text."""
    data, at = lower
    w = words(data, at, WORDS, letters_inside(data))
    plain = _canonical(data, w, units)
    kept = plain != 0
    yield 0, plain[kept], w.texts[kept], w.starts[kept], w.ends[kept]
    cased = words(*raw, WORDS, letters_inside(raw[0]))
    capital, begins = np.zeros(len(plain), bool), np.zeros(len(plain), bool)
    mine, theirs = np.bincount(w.texts, minlength=len(at)), np.bincount(cased.texts, minlength=len(at))
    # lower case hardly ever has other words; such a text has no names
    same = mine == theirs
    for here, there in zip((capital, begins), _names(raw[0], cased), strict=True):
        here[same[w.texts]] = there[same[cased.texts]]
    opens = capital & begins & (openers[np.minimum(np.searchsorted(openers, w.hashes), len(openers) - 1)] != w.hashes)
    for form, name in ((NAMED, capital & ~begins), (OPENING, capital & ~begins | opens)):
        if not name.any():
            continue
        named = np.where(name & (plain != _UNIT) & (plain != _NUMBER) & (plain != 0), _NAME, plain)
        goes_on = np.zeros(len(named), bool)
        goes_on[1:] = (named[1:] == _NAME) & (named[:-1] == _NAME) & (w.texts[1:] == w.texts[:-1]) & ~begins[1:]
        kept = (plain != 0) & ~goes_on
        last = np.append(np.flatnonzero(kept)[1:], len(named)) - 1  # the end of a run of names
        ends = np.where(named[kept] == _NAME, w.ends[last], w.ends[kept])
        if form == OPENING:
            # an item of no such name has nothing to gain; in documents the name may also stand elsewhere
            use = np.bincount(w.texts[opens if whole else name], minlength=len(at)) > 0
            kept, ends = kept & use[w.texts], ends[use[w.texts[kept]]]
        yield form, named[kept], w.texts[kept], w.starts[kept], ends
    yield VERBATIM, w.hashes, w.texts, w.starts, w.ends


def _windows(lower: tuple[np.ndarray, np.ndarray], raw: tuple[np.ndarray, np.ndarray], sizes: list[int], units: np.ndarray, openers: np.ndarray, whole: bool) -> Iterator[tuple]:
    """(form, text, place of the window in the text, hash, size, canonical hashes, starts, ends, first word of
    each window). With `whole`, a text of fewer than WINDOW words gives one window, else every size is slid;
    the verbatim form is then only of texts that the plain form leaves windows out of."""
    left_out = np.zeros(len(lower[1]) - 1, np.int64)  # windows of the plain form less those that count
    none = np.ones(len(lower[1]) - 1, bool)
    for form, canonical, texts, starts, ends in _forms(lower, raw, units, openers, whole):
        slot = (canonical == _NUMBER) | (canonical == _UNIT) | (canonical == _NAME) if form != VERBATIM else np.zeros(len(canonical), bool)
        slots = np.concatenate([[0], np.cumsum(slot)])
        names = np.concatenate([[0], np.cumsum(canonical == _NAME)])
        bounds = np.searchsorted(texts, np.arange(len(lower[1])))
        lengths = np.diff(bounds)
        for size in sizes:
            hashes = windows(canonical, size)
            first = np.arange(len(hashes))
            if not len(first):
                continue
            good = texts[first] == texts[first + size - 1]
            if whole and size < WINDOW:
                good &= lengths[texts[first]] == size
            if form == 0 and whole:
                left_out += np.bincount(texts[first[good]], minlength=len(left_out))
            good &= (slots[first + size] - slots[first]) <= (1 - LITERAL) * size
            if form == 0 and whole:
                counted = np.bincount(texts[first[good]], minlength=len(left_out))
                left_out -= counted
                none &= counted == 0
            if form == VERBATIM and whole:
                good &= (none | (left_out > 0))[texts[first]]
            if form == NAMED:
                good &= names[first + size] > names[first]
            first = first[good]
            yield form, texts[first], first - bounds[texts[first]], mix(hashes[first] + PLACES[50 + form]), size, slot, starts, ends, first


_COLUMNS = ["id", "form", "hash", "pos", "size", "slots"]
_SCHEMA = "id long, form int, hash long, pos int, size int, slots array<string>"


def _rows(table: DataFrame, id_column: str, sizes: list[int], wanted=None) -> DataFrame:
    """Windows of `table`, (id, form, hash, pos, size, slots); only those in the bitmap if one is given.
    slots are the texts in the placeholders, lower-cased, each with its place in the window."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, openers = _word_hashes(UNITS), _word_hashes(OPENERS)
        for batch in batches:
            ids = batch.column("id")
            cased, edges = text_buffer(batch.column("text"))
            for first_text, last_text, data, at in slices(batch.column("lowered")):
                raw = cased[edges[first_text] : edges[last_text]], edges[first_text : last_text + 1] - edges[first_text]
                for form, texts, pos, hashes, size, slot, starts, ends, first in _windows((data, at), raw, sizes, units, openers, wanted is None):
                    if wanted is not None:
                        hit = in_bitmap(wanted.value, hashes)
                        texts, pos, hashes, first = texts[hit], pos[hit], hashes[hit], first[hit]
                    if not len(first):
                        continue
                    slots = [[f"{k} {bytes(data[starts[i + k] : ends[i + k]]).decode(errors='replace')}" for k in np.flatnonzero(slot[i : i + size])] for i in first.tolist()]
                    n = len(first)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(texts + first_text)), pa.array(np.full(n, form, np.int32)), pa.array(hashes.view(np.int64)), pa.array(pos.astype(np.int32)), pa.array(np.full(n, size, np.int32)), pa.array(slots, pa.list_(pa.string()))],
                        _COLUMNS,
                    )

    return table.select(F.col(id_column).cast("long").alias("id"), "text", F.lower("text").alias("lowered")).mapInArrow(scan, _SCHEMA)


def find_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, form, windows, item_windows, coverage, consistency, kind) for each document of
    `docs` (doc_id, text) and item of `benchmark` (item_id, text) that the document holds.

    An item is held if the share of its windows in the document reaches PERCENT, or RUN_WINDOWS of them
    do, on one alignment whose slots are consistent or on all of these together, if they are consistent with one another. kind is `verbatim` if every slot has the
    item's own value, else `reparameterised`. The better form counts. Items of fewer than WINDOW words
    are one window. Windows of which less than LITERAL is plain words don't count as templates; an item that
    has such windows is also looked for word by word, numbers included (the verbatim form). NULL texts are empty, empty texts hold and are nothing; NULL ids are left out;
    repeated documents or items count once; other columns are ignored."""
    spark = docs.sparkSession
    docs = docs.where("doc_id IS NOT NULL")
    # items may be any number: their windows are a table, only the bitmap of fixed size is broadcast
    items = checkpoint(_rows(benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct(), "item_id", list(range(2, WINDOW + 1))))
    # shorter windows only for whole items: at most WINDOW - 2 sizes
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    if not sizes:
        sizes = [WINDOW]
    totals = items.groupBy(F.col("id").alias("item_id"), "form").agg(F.countDistinct("pos").cast("int").alias("item_windows"))
    wanted = bitmap(spark, items, F.col("hash"), BITMAP_BITS)
    # a window that many documents have is joined in SALTS parts
    salt = F.pmod(F.xxhash64("doc_id", "at"), F.lit(SALTS))
    found = _rows(docs, "doc_id", sizes, wanted).select(F.col("id").alias("doc_id"), "form", "hash", "size", F.col("pos").alias("at"), F.col("slots").alias("filled"))
    found = found.distinct().withColumn("salt", salt.cast("int"))
    items = items.select(F.col("id").alias("item_id"), "form", "hash", "size", "pos", "slots").distinct()
    items = items.withColumn("salt", F.explode(F.array(*(F.lit(k) for k in range(SALTS)))))
    met = checkpoint(found.join(items, ["form", "hash", "size", "salt"]).select("doc_id", "item_id", "form", "at", "pos", "slots", "filled"))

    line = ["doc_id", "item_id", "form", "shift"]
    met = met.withColumn("shift", F.col("at") - F.col("pos"))
    filled = met.select(*line, "pos", F.explode(F.arrays_zip("slots", "filled")).alias("slot")).select(*line, F.expr("substr(slot.slots, instr(slot.slots, ' ') + 1)").alias("theirs"), F.expr("substr(slot.filled, instr(slot.filled, ' ') + 1)").alias("ours"))

    def judged(rows: DataFrame, slots: DataFrame, keys: list[str]) -> DataFrame:
        """`rows` of keys whose values each stand for one value of the document, for the most part."""
        only = lambda c: (F.min("ours") == c) & (F.max("ours") == c)
        values = slots.groupBy(*keys, "theirs").agg((F.min("ours") == F.max("ours")).cast("int").alias("one"), only(F.col("theirs")).cast("int").alias("same"))
        lines = values.groupBy(*keys).agg(F.avg("one").alias("consistency"), F.min("same").alias("same"))
        return rows.join(lines, keys, "left").fillna(1.0, ["consistency"]).fillna(1, ["same"]).where(F.col("consistency") >= CONSISTENT)

    # an item can lie on several alignments, as words were put in; then its values stand for one value over all of them
    pair = ["doc_id", "item_id", "form"]
    along = checkpoint(judged(met.select(*line, "pos"), filled, line))
    whole = judged(along.select(*line, "pos"), filled.join(along.select(*line).distinct(), line, "left_semi"), pair)
    share = lambda rows, keys: rows.groupBy(*keys).agg(F.countDistinct("pos").cast("int").alias("windows"), F.min("consistency").alias("consistency"), F.min("same").alias("same"))
    shares = share(along, line).drop("shift").unionByName(share(whole, pair))
    shares = shares.join(totals, ["item_id", "form"]).where(f"100 * windows >= {PERCENT} * item_windows OR windows >= {RUN_WINDOWS}")
    shares = shares.withColumn("coverage", F.round(F.col("windows") / F.col("item_windows"), 4))
    best = shares.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("form", "windows", "item_windows", "coverage", "consistency", "same"), F.struct("coverage", -F.col("form"))).alias("best"))
    return best.select(
        "doc_id", "item_id", "best.form", "best.windows", "best.item_windows", "best.coverage", F.round("best.consistency", 4).alias("consistency"), F.when(F.col("best.same") == 1, "verbatim").otherwise("reparameterised").alias("kind")
    )
