"""Toxicity of texts that may be disguised: noisy-channel restoration, then a learned score.

1. Character language model. Letters of all texts are folded to ALPHABET codes (word edge, a to z,
   any letter beyond ASCII), and runs of ORDER codes are counted over the whole corpus: partial
   counts per task, added up by Spark. The model has ALPHABET ** ORDER cells whatever the size of
   the corpus, 2.4 MB as 32-bit floats, and that is what is broadcast. Shorter contexts smooth
   longer ones.
2. Restoration. A stretch without white space is a unit, and so is a row of SPACED or more single
   signs with spaces between. A unit of letters only, without a letter three times in a row, stays.
   Any other unit that has a letter becomes a lattice: a sign may be read as one of the letters it
   resembles, as a word edge, or as nothing; a repeated letter as itself or as nothing. The
   Viterbi path, best by language model less the costs of the readings, is the restored unit. Its
   states are the last ORDER - 1 codes, so the search is exact and linear in the unit.
3. Score. Labelled documents outside the held-out third, at most SAMPLE of them, are restored; near
   copies (equal smallest shingle) with one label count once. Features are whole words and
   beginnings of words (inflected and compound forms share those), each found once, twice or three
   times. The STEMS features that tell toxic from clean documents best (G-test) enter a logistic
   regression with the length of the text; every document is scored by it.

Every document is scored over its whole text; only the labels for learning are a sample. Labels,
lang, source and doc_id are never inputs of a score.

Defined cases: a NULL or empty text scores what a text without features does; with labels of one
kind only, or none, every score is their toxic share (none: 0); a NULL doc_id is not held out and has no label; of several labels
of one doc_id the highest counts, NULL labels are none; repeated rows are scored each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.common import cut, has_columns, ship_package
from stockflow.llm.shingles import shingle_hashes, text_slices
from stockflow.llm.word_bytes import LOWER, byte_class, runs_of

ORDER = 4
ALPHABET = 28
EDGE, BEYOND = 0, 27
SMOOTHING = 4.0
SPACED = 3
SAMPLE = 10_000
STEMS = 300
LEVELS = 3
SHORTEST, LONGEST = 3, 8  # letters of a beginning
LEAST = 4  # toxic documents with a feature
PENALTY = 0.5
FLAG_AT = 0.7
SLICE_BYTES = 4 << 20

# fixed values: letters that signs stand for
RESEMBLES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
    "*": "aeiou", "#": "aeiou",
}
# what readings cost, in nats
AS_LETTER, AS_ANY_VOWEL, AS_EDGE, AS_NOTHING, REPEATED, JOINED = 1.0, 2.5, 2.0, 4.0, 1.0, 0.5

_SOLID = ~byte_class((0x20, 0x20), (0x09, 0x0D))
_TRAILING = "!?.,;:&%*#\"')]}»…"
_LEADING = "\"'([{«¿"
_LETTER_RUN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_ANY_LETTER = re.compile(r"[a-z]")

# codes of bytes after lower-casing; the second and later bytes of a character have none
_CODES = np.zeros(256, np.int64)
_CODES[0x61:0x7B] = np.arange(1, 27)
_CODES[0xC0:] = BEYOND
_LATER = byte_class((0x80, 0xBF))


# -- the character language model ---------------------------------------------------


def _slice_counts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How often each run of ORDER codes occurs in some texts."""
    # an edge before and behind each text
    codes = np.insert(np.where(_LATER[data], -1, _CODES[LOWER[data]]), edges, EDGE)
    codes = codes[codes >= 0]
    # neighbouring edges are one
    codes = codes[np.concatenate([[True], (codes[1:] != EDGE) | (codes[:-1] != EDGE)])]
    # a word's first letters have edges as context
    starts = np.flatnonzero(codes == EDGE)
    codes = np.insert(codes, np.repeat(starts, ORDER - 2), EDGE)
    if len(codes) < ORDER:
        return np.zeros(ALPHABET**ORDER, np.int64)
    runs = np.zeros(len(codes) - ORDER + 1, np.int64)
    for i in range(ORDER):
        runs = runs * ALPHABET + codes[i : len(codes) - ORDER + 1 + i]
    return np.bincount(runs, minlength=ALPHABET**ORDER)


def run_counts(docs: DataFrame) -> DataFrame:
    """Runs of ORDER codes and their counts over all texts: ALPHABET ** ORDER rows at most."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALPHABET**ORDER, np.int64)
        for batch in batches:
            for data, edges in text_slices(batch.column(0), SLICE_BYTES):
                total += _slice_counts(data, edges)
        found = np.flatnonzero(total).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["run", "n"])

    partial = has_columns(docs, "text").mapInArrow(count, "run int, n long")
    return partial.groupBy("run").agg(F.sum("n").alias("n"))


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Of each run of codes: the log probability of its last one after the others."""
    grams = counts.reshape((ALPHABET,) * ORDER).astype(np.float64)
    chance = np.full(ALPHABET, 1.0 / ALPHABET)
    for length in range(1, ORDER + 1):
        # counts of the last ``length`` codes, whatever stands before
        shorter = grams.sum(axis=tuple(range(ORDER - length)))
        chance = (shorter + SMOOTHING * chance) / (shorter.sum(axis=-1, keepdims=True) + SMOOTHING)
    return np.log(chance).reshape(-1).astype(np.float32)


def language_model(docs: DataFrame) -> np.ndarray:
    counts, cells = np.zeros(ALPHABET**ORDER, np.int64), np.arange(ALPHABET**ORDER)
    # bounded by the number of cells
    found = run_counts(docs).toArrow()
    counts[found.column("run").to_numpy()] = found.column("n").to_numpy()
    # a letter three times in a row is disguise, not language
    codes = [cells // ALPHABET**place % ALPHABET for place in (3, 2, 1, 0)]
    thrice = [(a == b) & (b == c) & (a != EDGE) & (a != BEYOND) for a, b, c in zip(codes, codes[1:], codes[2:], strict=False)]
    counts[np.logical_or(*thrice)] = 0
    return log_probabilities(counts)


# -- restoration ----------------------------------------------------------------------


def _code(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else BEYOND


def _readings(sign: str, before: str) -> list[tuple[str | None, int, float]]:
    """How a sign may be read: what is written (None: nothing), its code, the cost."""
    if sign == " ":
        return [(None, EDGE, JOINED), (" ", EDGE, AS_EDGE)]
    if sign.isalpha():
        own = [(sign, _code(sign), 0.0)]
        return [*own, (None, EDGE, REPEATED)] if sign == before else own
    cost = AS_ANY_VOWEL if sign in "*#" else AS_LETTER
    letters = [(letter, _code(letter), cost) for letter in RESEMBLES.get(sign, "")]
    nothing = REPEATED if sign == before else JOINED if not letters else AS_NOTHING
    return [*letters, (" ", EDGE, AS_EDGE), (None, EDGE, nothing)]


def restore(unit: str, model) -> str:
    """The best reading of a unit (in lower case); word edges are spaces.

    Of equally good paths the one met first stays, so the result is fixed.
    """
    contexts = ALPHABET ** (ORDER - 1)
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    before = ""
    for sign in unit:
        following: dict[int, tuple[float, tuple | None]] = {}
        options = _readings(sign, before)
        for context, (score, path) in states.items():
            for written, code, cost in options:
                if written is None:
                    after, total, longer = context, score - cost, path
                elif code == EDGE:
                    if not context:
                        after, total, longer = 0, score - cost, path
                    else:
                        after, total, longer = 0, score - cost + model[context * ALPHABET], (path, written)
                else:
                    cell = context * ALPHABET + code
                    after, total, longer = cell % contexts, score - cost + model[cell], (path, written)
                known = following.get(after)
                if known is None or total > known[0]:
                    following[after] = (total, longer)
        states = following
        if sign != " ":
            before = sign
    best, path = None, None
    for context, (score, trail) in states.items():
        total = score + (model[context * ALPHABET] if context else 0.0)
        if best is None or total > best:
            best, path = total, trail
    written = []
    while path is not None:
        path, one = path
        written.append(one)
    return "".join(reversed(written)).strip()


def _ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else "".join(c.lower() if c < "\x80" else c for c in text)


def words_of_unit(unit: str, model) -> list[str]:
    """The words of a unit as it is, or as restored where it may be disguised."""
    core = _ascii_lower(unit).rstrip(_TRAILING).lstrip(_LEADING)
    if not _ANY_LETTER.search(core):
        return _LETTER_RUN.findall(core)
    if " " not in core and core.isalpha() and not _THRICE.search(core):
        return [core]
    return restore(core, model).split(" ")


def unit_words(data: np.ndarray, edges: np.ndarray, read) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of text number and what ``read`` returns for its units: a list of numbers each."""
    tokens, codes, offsets = runs_of(data, edges, _SOLID)
    distinct = tokens.cast(pa.large_string()).to_pylist()
    rows = [read(token) for token in distinct]
    sizes = np.array([len(row) for row in rows], np.int64)
    flat = np.array([n for row in rows for n in row], np.int64)
    texts = np.repeat(np.arange(len(edges) - 1), np.diff(offsets))
    # the numbers of each token, wherever it stands
    counts = sizes[codes]
    ends = np.cumsum(counts)
    places = np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - counts), counts) + np.arange(int(counts.sum()))
    pair_texts, pair_numbers = [np.repeat(texts, counts)], [flat[places]]
    # rows of single signs with spaces between
    single = np.array([len(token) == 1 for token in distinct], bool)[codes]
    first = single.copy()
    first[1:] &= ~single[:-1] | (texts[1:] != texts[:-1])
    starts = np.flatnonzero(first)
    lengths = np.bincount((np.cumsum(first) - 1)[single], minlength=len(starts))
    known: dict[str, list[int]] = {}
    for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
        if length >= SPACED:
            unit = " ".join(distinct[code] for code in codes[start : start + length].tolist())
            if unit not in known:
                known[unit] = read(unit)
            pair_texts.append(np.full(len(known[unit]), texts[start]))
            pair_numbers.append(np.array(known[unit], np.int64))
    return np.concatenate(pair_texts), np.concatenate(pair_numbers)


def stems(word: str) -> list[str]:
    """The features of a word: itself, with a space behind, and its beginnings."""
    if len(word) < SHORTEST:
        return []
    return [word + " ", *(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))]


# -- learning -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Weights:
    """A logistic regression: per stem what its first, second and third place add, the constant,
    and the weight of a text's length."""

    stems: dict[str, tuple[float, ...]]
    constant: float
    length: float = 0.0


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(labels: DataFrame, size: int) -> DataFrame:
    """At most ``size`` labels of documents that may be learned from, by the hash of their id."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
    )
    one = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def length_class(n_units: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(1 + n_units))


def _words_of_documents(docs: DataFrame, model) -> DataFrame:
    """doc_id, toxic, the smallest shingle, and the restored words with their counts and units."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = memoryview(model.value)
        for batch in batches:
            done = 0
            for data, edges in text_slices(batch.column(2), SLICE_BYTES):
                n, numbers = len(edges) - 1, {}

                def numbered(unit: str, numbers: dict = numbers) -> list[int]:
                    return [numbers.setdefault(word, len(numbers)) for word in words_of_unit(unit, cells) if word]

                texts, words = unit_words(data, edges, numbered)
                pairs, counts = np.unique(np.stack([texts, words]), axis=1, return_counts=True)
                hashes, ends = shingle_hashes(data, edges)
                smallest = np.zeros(n, np.uint64)
                some = np.diff(ends) > 0
                if some.any():
                    smallest[some] = np.minimum.reduceat(hashes, ends[:-1][some])
                names = pa.array(list(numbers), pa.string()).take(pa.array(pairs[1]))
                places = pa.array(np.searchsorted(pairs[0], np.arange(n + 1)), pa.int32())
                columns = [
                    *(column.slice(done, n) for column in batch.columns[:2]),
                    pa.array(smallest.view(np.int64)),
                    pa.ListArray.from_arrays(places, names),
                    pa.ListArray.from_arrays(places, pa.array(counts)),
                    pa.array(np.diff(runs_of(data, edges, _SOLID)[2])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "key", "words", "counts", "units"])
                done += n

    rows = docs.select("doc_id", "toxic", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        read, f"doc_id {kind}, toxic int, key long, words array<string>, counts array<bigint>, units long"
    )


def _levels(words: list[str], counts: list[int]) -> dict[str, int]:
    """How often each stem of a document occurs, LEVELS at most."""
    found: dict[str, int] = {}
    for word, n in zip(words, counts, strict=True):
        for stem in stems(word):
            found[stem] = found.get(stem, 0) + n
    return {stem: min(n, LEVELS) for stem, n in found.items()}


def _feature_counts(rows: DataFrame) -> DataFrame:
    """stem, level, and how many toxic (t) and clean (c) documents have the stem so often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[str, int], list[int]] = {}
            for toxic, words, counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                for stem, most in _levels(words, counts).items():
                    for level in range(1, most + 1):
                        held.setdefault((stem, level), [0, 0])[1 - toxic] += 1
            keys, values = list(held), list(held.values())
            columns = [[k[0] for k in keys], [k[1] for k in keys], [v[0] for v in values], [v[1] for v in values]]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["stem", "level", "t", "c"]
            )

    partial = rows.select("toxic", "words", "counts").mapInArrow(count, "stem string, level int, t long, c long")
    return partial.groupBy("stem", "level").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def _best_features(rows: DataFrame, toxic: int, clean: int, most: int) -> list[tuple[str, int]]:
    """The features whose documents differ most from chance; of a stem and its beginnings that
    stand in the same numbers of documents, the longest."""

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(F.lit(0.0))

    share, t, c = toxic / (toxic + clean), F.col("t"), F.col("c")
    with_it, without = t + c, F.lit(toxic + clean) - t - c
    deviation = (
        part(t, with_it * share)
        + part(c, with_it * (1 - share))
        + part(F.lit(toxic) - t, without * share)
        + part(F.lit(clean) - c, without * (1 - share))
    )
    likely = _feature_counts(rows).where((t >= LEAST) & (t * clean > c * 3 * toxic))
    # a fixed number of rows
    top = likely.orderBy(F.round(deviation, 6).desc(), F.length("stem").desc(), "stem", "level").limit(10 * most).collect()
    chosen: list[tuple[str, int]] = []
    seen: set[tuple] = set()
    for row in top:
        beginning = row["stem"][:SHORTEST]
        numbers = (beginning, row["level"], row["t"], row["c"])
        if numbers not in seen:
            seen.add(numbers)
            chosen.append((row["stem"], row["level"]))
    return chosen[:most]


def fit(features: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method; the first two columns are hardly penalised."""
    beta, penalty = np.zeros(features.shape[1]), np.full(features.shape[1], PENALTY)
    penalty[:2] = 1e-3

    def loss(beta: np.ndarray) -> float:
        margin = features @ beta
        return float((weight * (np.logaddexp(0, margin) - toxic * margin)).sum() + (penalty * beta * beta).sum() / 2)

    now = loss(beta)
    for _ in range(100):
        chance = 1 / (1 + np.exp(-(features @ beta)))
        slope = features.T @ (weight * (toxic - chance)) - penalty * beta
        curve = (features.T * (weight * chance * (1 - chance))) @ features + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        while loss(beta + step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        beta, now = beta + step, loss(beta + step)
        if np.abs(step).max() < 1e-7:
            break
    return beta


def learn(docs: DataFrame, labels: DataFrame, model, sample: int = SAMPLE, most: int = STEMS) -> Weights:
    """A score from at most ``sample`` labelled documents; ``model`` is a broadcast."""
    # at most ``sample`` rows are broadcast
    labelled = has_columns(docs, "doc_id", "text").join(F.broadcast(_sample(labels, sample)), "doc_id")
    read = _words_of_documents(labelled, model)
    # one of each group of near copies with one label
    first = F.min(F.struct("doc_id", "units", "words", "counts")).alias("first")
    rows = cut(read.groupBy("key", "toxic").agg(first).select("toxic", "first.*"))
    numbers = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    toxic, clean = numbers.get(1, 0), numbers.get(0, 0)
    if not toxic or not clean:
        return Weights({}, math.inf if toxic else -math.inf)
    features = _best_features(rows, toxic, clean, most)
    wanted = {stem for stem, _ in features}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for words, counts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = {stem: n for stem, n in _levels(words, counts).items() if stem in wanted}
                lists.append([i for i, (stem, level) in enumerate(features) if found.get(stem, 0) >= level])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.list_(pa.int64())), batch.column(3)],
                names=["toxic", "features", "units"],
            )

    placed = rows.select("toxic", "words", "counts", "units").mapInArrow(
        place, "toxic int, features array<bigint>, units long"
    )
    # alike documents are one row: at most one per sampled document, of numbers below ``most``
    alike = placed.withColumn("units", F.floor(F.log2(F.col("units") + 1))).groupBy("toxic", "features", "units").count()
    gathered = sorted(alike.collect(), key=lambda row: (row["toxic"], row["units"], row["features"]))
    matrix = np.zeros((len(gathered), len(features) + 2))
    matrix[:, 0] = 1
    for i, row in enumerate(gathered):
        matrix[i, 1] = row["units"]
        matrix[i, [2 + k for k in row["features"]]] = 1
    beta = fit(
        matrix, np.array([row["toxic"] for row in gathered], float), np.array([row["count"] for row in gathered], float)
    ).tolist()
    added = {stem: [0.0] * LEVELS for stem in sorted(wanted)}
    for (stem, level), value in zip(features, beta[2:], strict=True):
        added[stem][level - 1] = value
    return Weights({stem: tuple(values) for stem, values in added.items()}, beta[0], beta[1])


# -- scores -------------------------------------------------------------------------------


def score_documents(docs: DataFrame, model, weights: Weights) -> DataFrame:
    """doc_id, score, and the features found in the restored text (whole words end in a space)."""
    names = list(weights.stems)
    known, beginnings = {name: i for i, name in enumerate(names)}, {name[:SHORTEST] for name in names}
    # what a stem adds that occurs 0, 1, 2, ... times
    worth = np.zeros((len(names), LEVELS + 1))
    if names:
        worth[:, 1:] = np.cumsum([weights.stems[name] for name in names], axis=1)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = memoryview(model.value)

        def wanted(unit: str) -> list[int]:
            words = [word for word in words_of_unit(unit, cells) if word[:SHORTEST] in beginnings]
            return [known[stem] for word in words for stem in stems(word) if stem in known]

        for batch in batches:
            done = 0
            for data, edges in text_slices(batch.column(1), SLICE_BYTES):
                n = len(edges) - 1
                texts, found = unit_words(data, edges, wanted)
                pairs, counts = np.unique(np.stack([texts, found]), axis=1, return_counts=True)
                margin = np.full(n, weights.constant)
                if names:
                    margin += weights.length * length_class(np.diff(runs_of(data, edges, _SOLID)[2]))
                    margin += np.bincount(pairs[0], worth[pairs[1], np.minimum(counts, LEVELS)], n)
                places = pa.array(np.searchsorted(pairs[0], np.arange(n + 1)), pa.int32())
                terms = pa.ListArray.from_arrays(places, pa.array(names, pa.string()).take(pa.array(pairs[1])))
                with np.errstate(over="ignore"):
                    score = 1 / (1 + np.exp(-margin))
                columns = [batch.column(0).slice(done, n), pa.array(score), terms]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "terms"])
                done += n

    rows = has_columns(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, score double, terms array<string>")


def broadcast_model(spark: SparkSession, cells: np.ndarray):
    """The language model for all tasks: ALPHABET ** ORDER 32-bit floats."""
    return spark.sparkContext.broadcast(cells)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every document's doc_id, held_out, score, predicted and terms."""
    spark = docs.sparkSession
    ship_package(spark)
    model = broadcast_model(spark, language_model(docs))
    scored = score_documents(docs, model, learn(docs, labels, model, sample))
    flagged = (F.col("score") >= FLAG_AT).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", flagged, "terms")
