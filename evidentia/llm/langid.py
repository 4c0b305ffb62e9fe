"""Language identification with interpolated Kneser-Ney character models.

One model per language over character 4-grams. Counting is a Spark job over
all training rows (counted per task, then added up). Lower orders use
continuation counts, so they follow from the table of distinct 4-grams. Up to
``max_cells / languages`` of these the driver derives the model and broadcasts
it. Beyond, Spark derives the same tables of all orders from all n-grams
(:func:`spread`); only the values of the most frequent 4-grams are broadcast,
and what a text has besides is looked up by joins (:func:`looked_up`). No
n-gram is dropped, and results don't depend on ``max_cells``.

The tables are sorted arrays of 64-bit hashes (a bijection of four UTF-16
units, so no two n-grams collide) with a directory over the leading bits; every
n-gram seen in any language has its interpolated probability for all languages,
so that a character costs one look-up unless the n-gram is new.

The language with the lowest cross-entropy per character wins. Confidence and
rejection are calibrated on labelled rows that the counts leave out, chosen by
hash within each language and taken once if repeated: a tenth of its rows, at most about ``sample_rows``
divided by the number of languages, and about 60 (but no more than a quarter of
its rows) if a tenth is less. A language with fewer than 30 such rows is judged
by the widest limits that the rows of all languages give (:func:`calibrate`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from evidentia.llm.common import columns, stored

ORDER = 4
UNKNOWN = "und"
_START, _GAP = 0, 32
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNIT = np.uint64(16)
_SEGMENT = 1 << 20
#: Calibration rows that each language should have, and those it needs for a threshold of its own.
_WANTED, _ENOUGH = 60, 30


def _folding() -> np.ndarray:
    """UTF-16 unit -> itself for a letter (or half of a surrogate pair), else a gap."""
    table = np.full(1 << 16, _GAP, np.uint16)
    for unit in range(1 << 16):
        if 0xD800 <= unit < 0xE000 or chr(unit).isalpha():
            table[unit] = unit
    table[_START] = _START
    return table


_FOLD: list[np.ndarray] = []


def fold() -> np.ndarray:
    if not _FOLD:
        _FOLD.append(_folding())
    return _FOLD[0]


def segments(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """(row numbers, pieces of texts) of about a megabyte; long texts are cut into pieces, none is left out."""
    rows: list[int] = []
    pieces: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        for at in range(0, len(text or ""), _SEGMENT):
            piece = text[at : at + _SEGMENT]
            rows.append(row)
            pieces.append(piece)
            size += len(piece)
            if size >= _SEGMENT:
                yield rows, pieces
                rows, pieces, size = [], [], 0
    if rows:
        yield rows, pieces


def _coded(piece: str) -> bytes:
    """UTF-16 units of a lower-case piece with three starts before it; signs beyond U+FFFF that are no letters are gaps."""
    low = piece.lower().replace("\0", " ")
    coded = ("\0\0\0" + low).encode("utf-16-le", "surrogatepass")
    if len(coded) == 2 * len(low) + 6:
        return coded
    low = "".join(c if c < "\U00010000" or c.isalpha() else " " for c in low)
    return ("\0\0\0" + low).encode("utf-16-le", "surrogatepass")


def ngrams(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(4-gram keys, piece of each, is a letter) over folded, lower-case pieces with starts padded."""
    coded = [_coded(p) for p in pieces]
    units = fold()[np.frombuffer(b"".join(coded), "<u2")]
    owner = np.repeat(np.arange(len(coded), dtype=np.int32), [len(c) // 2 for c in coded])
    keep = np.ones(len(units), bool)
    keep[1:] = (units[1:] != _GAP) | (units[:-1] != _GAP)
    units, owner = units[keep].astype(np.uint64), owner[keep]
    key = units[3:].copy()
    for back in range(1, ORDER):
        key |= units[3 - back : len(units) - back] << np.uint64(16 * back)
    real = units[3:] != _START
    return key[real], owner[3:][real], units[3:][real] != _GAP


class HashTable:
    """Row numbers of 64-bit keys: sorted hashes and a directory of their leading bits."""

    def __init__(self, keys: np.ndarray):
        mixed = keys * _MIX
        self.order = np.argsort(mixed, kind="stable").astype(np.int64)
        self.hashes = np.append(mixed[self.order], np.uint64(0))
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        tops = (self.hashes[:-1] >> self.shift).astype(np.int64)
        self.starts = np.searchsorted(tops, np.arange((1 << bits) + 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 for those not held."""
        mixed = keys * _MIX
        top = (mixed >> self.shift).astype(np.int64)
        at, end = self.starts[top], self.starts[top + 1]
        out = np.full(len(keys), -1, np.int64)
        left = np.flatnonzero(at < end)
        at, end, mixed = at[left], end[left], mixed[left]
        while len(left):
            held = self.hashes[at]
            hit = held == mixed
            out[left[hit]] = self.order[at[hit]]
            go = (held < mixed) & (at + 1 < end)
            left, at, end, mixed = left[go], at[go] + 1, end[go], mixed[go]
        return out


@dataclass
class Rest:
    """Tables (key, v) of every order: log-probabilities of n-grams, log back-off weights of contexts."""

    grams: dict[int, DataFrame] = field(default_factory=dict)
    contexts: dict[int, DataFrame] = field(default_factory=dict)


@dataclass
class Model:
    """Log-probabilities by order: n-gram table with a row of languages, contexts with back-off weights.

    With ``rest`` (tables of all n-grams, read by joins) the arrays hold only
    the most frequent 4-grams.
    """

    languages: list[str]
    grams: dict[int, tuple[HashTable, np.ndarray]] = field(default_factory=dict)
    contexts: dict[int, tuple[HashTable, np.ndarray]] = field(default_factory=dict)
    temperature: float = 1.0
    typical: np.ndarray | None = None
    slack: np.ndarray | None = None
    rest: Rest | None = None

    def log_probabilities(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Rows of log P(last character | the order - 1 before it), one column per language."""
        if order == 0:
            return np.full((len(keys), len(self.languages)), -16 * np.log(2), np.float32)
        if order not in self.grams:
            return self.log_probabilities(keys, 0)
        table, values = self.grams[order]
        row = table.find(keys)
        out = values[row] if len(values) else np.zeros((len(keys), len(self.languages)), np.float32)
        miss = np.flatnonzero(row < 0)
        if len(miss) and order not in self.contexts:
            out[miss] = self.log_probabilities(keys[miss], 0)
        elif len(miss):
            lower = keys[miss] & np.uint64((1 << 16 * (order - 1)) - 1)
            table, weights = self.contexts[order]
            seen = table.find(keys[miss] >> _UNIT)
            back = np.where((seen >= 0)[:, None], weights[seen], np.float32(0))
            out[miss] = back + self.log_probabilities(lower, order - 1)
        return out

    def cross_entropies(self, texts: list[str | None], held_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nats per character by language, characters, letters) of each text.

        With ``held_only`` the 4-grams that the arrays lack count as 0 nats.
        """
        total = np.zeros((len(texts), len(self.languages)))
        size, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for rows, pieces in segments(texts):
            keys, owner, letter = ngrams(pieces)
            if not len(keys):
                continue
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rows = np.asarray(rows)[owner[first]]
            if self.languages:
                values = self.held(keys) if held_only else self.log_probabilities(keys)
                np.add.at(total, rows, np.add.reduceat(values, first, axis=0, dtype=np.float64))
            np.add.at(size, rows, np.diff(np.r_[first, len(owner)]))
            np.add.at(letters, rows, np.add.reduceat(letter.astype(np.int64), first))
        return -total / np.maximum(size, 1)[:, None], size, letters

    def held(self, keys: np.ndarray) -> np.ndarray:
        table, values = self.grams[ORDER]
        row = table.find(keys)
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        out[row >= 0] = values[row[row >= 0]]
        return out

    def missing(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct 4-grams of a text that the arrays lack, and how often it has them."""
        found, times = np.empty(0, np.uint64), np.empty(0, np.int64)
        for _, pieces in segments([text]):
            keys, _, _ = ngrams(pieces)
            keys, n = np.unique(keys[self.grams[ORDER][0].find(keys) < 0], return_counts=True)
            found, inverse = np.unique(np.r_[found, keys], return_inverse=True)
            times = np.bincount(inverse, np.r_[times, n], len(found)).astype(np.int64)
        return found, times

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        return self.judge(*self.cross_entropies(texts))

    def judge(self, entropy: np.ndarray, size: np.ndarray, letters: np.ndarray) -> pd.DataFrame:
        known = (letters > 0) & (len(self.languages) > 0)
        if not self.languages:
            entropy = np.zeros((len(size), 1))
        best = entropy.argmin(1)
        lowest = entropy[np.arange(len(best)), best]
        score = 1 / np.exp((lowest[:, None] - entropy) * self.scale(size)[:, None]).sum(1)
        excess = np.zeros(len(best))
        if self.slack is not None and len(self.slack):
            excess = (lowest - self.typical[best]) * np.sqrt(np.minimum(size, 400)) - self.slack[best]
        return pd.DataFrame(
            {
                "lang_pred": [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
                "score": np.where(known, score, 0.0),
                "cross_entropy": np.where(known, lowest, 0.0),
                "rejected": ~known | (excess > 0),
            }
        )

    def scale(self, size: np.ndarray) -> np.ndarray:
        return self.temperature * np.sqrt(size)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """4-gram counts of each language, added up within the task (in bounded memory)."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(language, keys, counts):
        old = sums.get(language)
        if old is not None:
            keys, counts = np.r_[old[0], keys], np.r_[old[1], counts]
        keys, inverse = np.unique(keys, return_inverse=True)
        sums[language] = keys, np.bincount(inverse, counts).astype(np.int64)

    def flush():
        for language, (keys, counts) in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([language] * len(keys)), "key": keys.view(np.int64), "n": counts}
            )
        sums.clear()

    for batch in batches:
        texts, languages = batch["text"].to_pylist(), batch["lang"].to_pylist()
        for language in sorted(set(languages)):
            own = [t for t, x in zip(texts, languages) if x == language]
            for _, pieces in segments(own):
                keys, _, _ = ngrams(pieces)
                keys, counts = np.unique(keys, return_counts=True)
                add(language, keys, counts)
        if sum(len(k) for k, _ in sums.values()) > 4_000_000:
            yield from flush()
    yield from flush()


def count_ngrams(labelled: DataFrame) -> DataFrame:
    """(lang, key, n) over all rows of (lang, text)."""
    rows = labelled.select("lang", "text").where("lang is not null and text is not null")
    return rows.mapInArrow(_counted, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def kneser_ney(languages: list[str], keys: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated models from distinct 4-gram keys and counts (rows) by language (columns)."""
    tables = {ORDER: (keys, counts)}
    for order in range(ORDER - 1, 0, -1):
        above, n = tables[order + 1]
        lower = above & np.uint64((1 << 16 * order) - 1)
        distinct, inverse = np.unique(lower, return_inverse=True)
        n = np.stack([np.bincount(inverse, n[:, i] > 0, len(distinct)) for i in range(len(languages))], 1)
        tables[order] = distinct, n
    model = Model(languages)
    for order in range(1, ORDER + 1):
        grams, n = tables[order]
        heads, inverse = np.unique(grams >> _UNIT, return_inverse=True)
        ones, twos = (n == 1).sum(0), (n == 2).sum(0)
        discount = np.where((ones > 0) & (twos > 0), ones / np.maximum(ones + 2 * twos, 1), 0.5)
        total = np.stack([np.bincount(inverse, n[:, i], len(heads)) for i in range(len(languages))], 1)
        kinds = np.stack([np.bincount(inverse, n[:, i] > 0, len(heads)) for i in range(len(languages))], 1)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        tail = grams & np.uint64((1 << 16 * (order - 1)) - 1)
        lower = np.exp(model.log_probabilities(tail, order - 1).astype(np.float64))
        seen = np.maximum(n - discount, 0) / np.maximum(total, 1)[inverse]
        value = np.log(seen + weight[inverse] * lower).astype(np.float32)
        model.grams[order] = HashTable(grams), value
        model.contexts[order] = HashTable(heads), np.log(weight).astype(np.float32)
    return model


def spread(languages: list[str], counted: DataFrame) -> tuple[DataFrame, Rest]:
    """((key, total, v) of the 4-grams, tables of all orders): :func:`kneser_ney` in Spark, over every n-gram of ``counted``."""
    each = range(len(languages))
    units = lambda count: F.lit((1 << 16 * count) - 1).cast("long")
    n = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)) for x in languages]
    tables = {ORDER: stored(counted.groupBy("key").agg(F.array(*n).alias("n")))}
    kinds = lambda: F.array(*[F.count_if(F.col("n")[i] > 0) for i in each])
    for order in range(ORDER - 1, 0, -1):
        lower = F.col("key").bitwiseAND(units(order)).alias("key")
        tables[order] = stored(tables[order + 1].select(lower, "n").groupBy("key").agg(kinds().alias("n")))
    rest, below, grams = Rest(), None, None
    for order in range(1, ORDER + 1):
        held = [F.count_if(F.col("n")[i] == k) for k in (1, 2) for i in each]
        seen = tables[order].agg(F.array(*held)).first()[0]
        discount = [a / (a + 2 * b) if a and b else 0.5 for a, b in zip(seen[: len(languages)], seen[len(languages) :])]
        rows = tables[order].withColumn("head", F.shiftrightunsigned("key", 16)).withColumn("tail", F.col("key").bitwiseAND(units(order - 1)))
        heads = rows.groupBy("head").agg(F.array(*[F.sum(F.col("n")[i]) for i in each]).alias("total"), kinds().alias("kinds"))
        weight = [F.when(F.col("total")[i] > 0, F.lit(discount[i]) * F.col("kinds")[i] / F.col("total")[i]).otherwise(1.0) for i in each]
        heads = stored(heads.select("head", "total", F.array(*weight).alias("weight")))
        rest.contexts[order] = heads.select(F.col("head").alias("key"), F.transform("weight", lambda w: F.log(w)).alias("v"))
        rows = rows.join(heads, "head")
        if below is None:
            rows = rows.withColumn("lower", F.array_repeat(F.lit(2.0**-16), len(languages)))
        else:
            rows = rows.join(below.select(F.col("key").alias("tail"), F.transform("v", lambda x: F.exp(x)).alias("lower")), "tail")
        value = [
            F.log(F.greatest(F.col("n")[i] - F.lit(discount[i]), F.lit(0.0)) / F.greatest(F.col("total")[i], F.lit(1)) + F.col("weight")[i] * F.col("lower")[i])
            for i in each
        ]
        total = F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y)
        grams = stored(rows.select("key", total.alias("total"), F.array(*value).alias("v")))
        below = rest.grams[order] = grams.select("key", "v")
    return grams, rest


def resolved(keys: DataFrame, rest: Rest, width: int, order: int = ORDER) -> DataFrame:
    """(key, v): log-probabilities of distinct n-grams, with back-off for those that no language has."""
    if order == 0:
        return keys.select("key", F.array_repeat(F.lit(-16 * float(np.log(2))), width).alias("v"))
    rows = stored(keys.join(rest.grams[order], "key", "left"))
    new = rows.where("v is null").select(
        "key", F.shiftrightunsigned("key", 16).alias("head"), F.col("key").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1).cast("long")).alias("tail")
    )
    lower = resolved(new.select(F.col("tail").alias("key")).distinct(), rest, width, order - 1)
    new = new.join(rest.contexts[order].select(F.col("key").alias("head"), F.col("v").alias("back")), "head", "left")
    new = new.join(lower.select(F.col("key").alias("tail"), "v"), "tail")
    back = F.coalesce("back", F.array_repeat(F.lit(0.0), width))
    return rows.where("v is not null").union(new.select("key", F.zip_with(back, "v", lambda x, y: x + y).alias("v")))


def looked_up(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with __entropy, __size and __letters of a model with ``rest``.

    Texts are known by a 128-bit digest, so copies are looked up once.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(replace(model, rest=None))
    width = len(model.languages)
    digest = lambda t: None if t is None else xxhash.xxh128_digest(t.encode("utf-8", "surrogatepass"))

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch["text"]:
                keys, times = shared.value.missing(text.as_py())
                if len(keys):
                    yield pa.RecordBatch.from_pydict({"digest": [digest(text.as_py())] * len(keys), "key": keys.view(np.int64), "times": times})

    @F.pandas_udf("digest binary, entropy array<double>, size long, letters long")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            entropy, size, letters = shared.value.cross_entropies(texts.tolist(), held_only=True)
            yield pd.DataFrame({"digest": [digest(t) for t in texts], "entropy": list(entropy), "size": size, "letters": letters})

    lacked = docs.select("text").mapInArrow(missing, "digest binary, key long, times long")
    lacked = stored(lacked.groupBy("digest", "key").agg(F.max("times").alias("times")))
    values = resolved(lacked.select("key").distinct(), model.rest, width)
    sums = [F.sum(F.col("times") * F.col("v")[i]) for i in range(width)]
    more = stored(lacked.join(values, "key").groupBy("digest").agg(F.array(*sums).alias("__more")))
    rows = docs.withColumn("__h", held.asNondeterministic()("text")).withColumn("__digest", F.col("__h.digest"))
    rows = rows.join(more.withColumnRenamed("digest", "__digest"), "__digest", "left")
    size = F.greatest(F.col("__h.size"), F.lit(1))
    entropy = F.zip_with("__h.entropy", F.coalesce("__more", F.array_repeat(F.lit(0.0), width)), lambda x, y: x - y / size)
    rows = rows.withColumn("__entropy", entropy).withColumn("__size", F.col("__h.size")).withColumn("__letters", F.col("__h.letters"))
    return rows.select(*columns(rows, "__h", "__digest", "__more"))


def fit(labelled: DataFrame, max_cells: int = 1 << 24, sample_rows: int = 5000, seed: int = 17) -> Model:
    """Models of all languages of ``labelled`` (lang, text); null languages and texts are left out.

    ``max_cells`` bounds what is broadcast (4-grams times languages), not what
    the models rest on. ``sample_rows``, but at least 60 a language, bounds the
    expected number of rows kept for the calibration.
    """
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    parts = {x: int(share * (1 << 20)) for x, share in shares(rows, sample_rows, seed).items()}
    least = F.create_map(*[F.lit(v) for part in parts.items() for v in part])[F.col("lang")] if parts else F.lit(0)
    apart = bucket(seed) < least
    counted = count_ngrams(rows.where(~apart)).persist()
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    if not languages:
        counted.unpersist()
        return Model([])
    most = max_cells // len(languages)
    if counted.select("key").distinct().count() <= most:
        got = counted.toArrow()
        keys, inverse = np.unique(got["key"].to_numpy().view(np.uint64), return_inverse=True)
        counts = np.zeros((len(keys), len(languages)))
        place = {x: i for i, x in enumerate(languages)}
        counts[inverse, [place[x] for x in got["lang"].to_pylist()]] = got["n"].to_numpy()
        model = kneser_ney(languages, keys, counts)
    else:
        grams, rest = spread(languages, counted)
        model = Model(languages, rest=rest)
        model.grams[ORDER] = frequent(grams, most, len(languages))
    counted.unpersist()
    calibrate(model, distinct_texts(rows.where(apart)))
    return model


def distinct_texts(rows: DataFrame) -> DataFrame:
    """One row of each (lang, text), so that many copies count once; texts are told apart by a digest."""
    return rows.groupBy("lang", F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text")).drop("digest")


def bucket(seed: int) -> Column:
    return F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 20))


def shares(rows: DataFrame, sample_rows: int, seed: int = 17) -> dict[str, float]:
    """Share of the rows of each language that the calibration takes; none if no row were left to count."""
    sizes = {r["lang"]: (r["n"], r["last"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.max(bucket(seed)).alias("last")).collect()}
    most = max(_WANTED, sample_rows / max(1, len(sizes)))
    wanted = {x: min(max(0.1, min(0.25, _WANTED / n)), most / n) for x, (n, _) in sizes.items()}
    return {x: share if sizes[x][1] >= int(share * (1 << 20)) else 0.0 for x, share in wanted.items()}


def frequent(grams: DataFrame, most: int, width: int) -> tuple[HashTable, np.ndarray]:
    """The 4-grams of the highest totals, at most ``most``; of a total all or none."""
    held, least = 0, 1
    for r in grams.groupBy("total").count().orderBy(F.desc("total")).toLocalIterator():
        held += r["count"]
        if held > most:
            least = r["total"] + 1
            break
    got = grams.where(F.col("total") >= least).select("key", F.col("v").cast("array<float>")).toArrow().combine_chunks()
    values = got["v"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    return HashTable(got["key"].to_numpy().view(np.uint64)), values


def calibrate(model: Model, sample: DataFrame) -> None:
    """Temperature by likelihood; rejection beyond three times the spread of 99.9 % of each language's own rows.

    A language with fewer than 30 rows takes the spread of the rows of all
    languages, each from the median of its own, about the highest of these
    medians. Without any row there is no evidence, and no text with a letter is
    rejected.
    """
    shared = sample.sparkSession.sparkContext.broadcast(replace(model, rest=None))

    def measured(batches):
        for batch in batches:
            entropy, size, letters = shared.value.cross_entropies(batch["text"].to_pylist())
            yield pa.RecordBatch.from_pydict(
                {"lang": batch["lang"], "entropy": pa.array(entropy.tolist(), pa.list_(pa.float64())), "size": size, "letters": letters}
            )

    if model.rest is None:
        rows = sample.mapInArrow(measured, "lang string, entropy array<double>, size long, letters long")
    else:
        rows = looked_up(sample, model).select("lang", *[F.col(f"__{x}").alias(x) for x in ("entropy", "size", "letters")])
    got = rows.where("letters > 0").toPandas()
    model.typical, model.slack = np.zeros(len(model.languages)), np.full(len(model.languages), np.inf)
    got = got[got["lang"].isin(model.languages)]
    if got.empty:
        return
    entropy, size = np.stack(got["entropy"]), got["size"].to_numpy()
    truth = np.array([model.languages.index(x) for x in got["lang"]])
    losses = []
    grid = 2.0 ** np.arange(-6, 7)
    for t in grid:
        logits = -entropy * (t * np.sqrt(size))[:, None]
        logits -= logits.max(1, keepdims=True)
        losses.append((np.log(np.exp(logits).sum(1)) - logits[np.arange(len(truth)), truth]).mean())
    model.temperature = float(grid[int(np.argmin(losses))])
    own = [np.flatnonzero(truth == i) for i in range(len(model.languages))]
    nats = entropy[np.arange(len(truth)), truth]
    medians = np.array([np.median(nats[rows]) if len(rows) else -np.inf for rows in own])
    spread = (nats - medians[truth]) * np.sqrt(np.minimum(size, 400))
    limit = lambda values: 3 * max(np.quantile(values, 0.999), 1.0)
    for i, rows in enumerate(own):
        thin = len(rows) < _ENOUGH
        model.typical[i] = medians.max() if thin else medians[i]
        model.slack[i] = limit(spread if thin else spread[rows])


def predictor(spark: SparkSession, model: Model):
    """A vectorised function: text -> (lang_pred, score, cross_entropy, rejected)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield shared.value.predict(texts.tolist())

    return predicted.asNondeterministic()  # evaluated once, also under a filter


def judged(spark: SparkSession, model: Model):
    """As :func:`predictor`, from cross-entropies, characters and letters."""
    shared = spark.sparkContext.broadcast(replace(model, rest=None, grams={}, contexts={}))

    @F.pandas_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def predicted(entropy: pd.Series, size: pd.Series, letters: pd.Series) -> pd.DataFrame:
        return shared.value.judge(np.stack(entropy), size.to_numpy(), letters.to_numpy())

    return predicted


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees: crc32 of the id as text, modulo 3, is 1. A null id is trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score, cross_entropy and rejected, from the text alone.

    Null texts and texts without a letter: ``und``, score 0, rejected. Also all
    texts if the model has no language. Ties go to the language that sorts
    first. Columns of the input with these names are replaced.
    """
    names = ("lang_pred", "score", "cross_entropy", "rejected")
    rows = docs.drop(*names)
    if model.rest is None:
        rows = rows.withColumn("__p", predictor(docs.sparkSession, model)("text"))
    else:
        rows = looked_up(rows, model).withColumn("__p", judged(docs.sparkSession, model)("__entropy", "__size", "__letters"))
        rows = rows.drop("__entropy", "__size", "__letters")
    return rows.select(*columns(rows, "__p"), "__p.*")
