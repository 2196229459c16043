"""Operator 4: language identification by compression.

Each language has a zstandard dictionary of raw content: the words and pairs of
words that make up most of its labelled texts. A text is compressed with every
dictionary; the language whose dictionary gives the smallest output wins. When
the two smallest outputs are nearly the same size, the decision is rejected:
text of no language, or of one that was not learned, is as large with every
dictionary. How near is fitted: a quarter of the margin that 99 of 100 labelled
texts reach, judged by dictionaries that do not hold them.

Texts are lower-cased and everything but letters becomes one space. Whole
texts are used, in blocks of ``BLOCK`` bytes, each compressed on its own: a
long text would otherwise serve as its own dictionary.

Fitting reads every labelled row and its whole text. Texts with the same
letters count once, whatever the number of copies. Words are counted in all of
them, then pairs of the ``PAIR_WORDS`` commonest words of a language (pairs of
rarer ones are too many to count and save next to nothing); a dictionary takes
those with the most bytes, its ``DICT_BYTES`` full. For the margin the texts
are halved by their hash and each half is judged by the counts of the other.
Only dictionaries and counts of margins reach the driver.

Defined results: null texts and texts without a letter are ``und`` with score
0 and are rejected; ties of size go to the language with more labelled rows,
then by name, and are rejected; a table without labelled rows gives ``und``
throughout; repeated rows and extra columns change nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nimbus.llm.common import prepare, remove_staged, staged, staged_folders

DICT_BYTES = 60_000
BLOCK = 2048
LEVEL = 5
# Pairs are counted of so many words a language.
PAIR_WORDS = 500
# Runs of more letters (scripts without spaces) are cut into pieces.
WORD_CHARS, PIECE_CHARS = 24, 4
# Different words or pairs that a task counts before it passes them on.
COUNTED = 100_000
# Margins are counted in steps of 1 / STEPS.
STEPS = 10_000
# Decisions below this relative difference of sizes are rejected in any case,
# and below this part of the margin that few labelled texts fall short of.
MIN_MARGIN = 0.001
MARGIN_SHARE, MARGIN_QUANTILE = 0.25, 0.01
UNKNOWN = "und"
_other = regex.compile(r"\P{L}+").sub


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no model learns from: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def letters(text: str | None) -> bytes:
    return _other(" ", text.lower()).strip().encode("utf-8") if text else b""


class Model(list):
    """``(language, dictionary content)``, the language with most rows first."""

    min_margin = MIN_MARGIN


def _words(raw: str) -> list[str]:
    words = raw.split(" ")
    if max(map(len, words)) > WORD_CHARS:
        words = [x for w in words for x in ([w] if len(w) <= WORD_CHARS else [w[i:i + PIECE_CHARS] for i in range(0, len(w), PIECE_CHARS)])]
    return words


def _learned(docs: DataFrame, sample_rows: int | None) -> DataFrame:
    """``lang, h, raw, copies``: the letters of the different labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([letters(t).decode() for t in b.column(1).to_pylist()], pa.string())], ["lang", "raw"])

    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    raw = usable.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, "lang string, raw string").where("raw != ''")
    texts = raw.groupBy("lang", F.xxhash64("raw").alias("h")).agg(F.min("raw").alias("raw"), F.count(F.lit(1)).alias("copies"))
    if sample_rows is not None:
        texts = texts.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= sample_rows).drop("k")
    return staged(texts, "language-texts")


def _counted(texts: DataFrame, units: Callable[[str, str], list[str]]) -> DataFrame:
    """``lang, unit, n0, n1``: how often the units of ``units(lang, raw)``
    stand in the texts of either half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], Counter] = {}

        def out() -> pa.RecordBatch:
            rows = [(k, u, n if not half else 0, n if half else 0) for (k, half), c in held.items() for u, n in c.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], ["lang", "unit", "n0", "n1"])

        for b in batches:
            for lang, half, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.setdefault((lang, half), Counter()).update(units(lang, raw))
            if sum(map(len, held.values())) > COUNTED:
                yield out()
        if held:
            yield out()

    halves = texts.select("lang", F.pmod("h", F.lit(2)).cast("int").alias("half"), "raw")
    return halves.mapInArrow(run, "lang string, unit string, n0 long, n1 long").groupBy("lang", "unit").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _dictionaries(counts: DataFrame, dict_bytes: int) -> dict[str, dict[str, bytes]]:
    """By what is counted (``n0``, ``n1``: one half, ``n``: all texts), for each
    language the units with the most bytes, these at the end, where matches
    are cheapest."""
    sides = F.explode(F.create_map(F.lit("n"), F.col("n0") + F.col("n1"), F.lit("n0"), F.col("n0"), F.lit("n1"), F.col("n1"))).alias("side", "n")
    size = F.octet_length("unit")
    one = counts.select("lang", "unit", sides).where("n > 0").withColumn("weight", F.col("n") * size)
    order = Window.partitionBy("side", "lang").orderBy(F.desc("weight"), "unit")
    # A unit has a byte and a space at least.
    first = one.withColumn("k", F.row_number().over(order)).where(F.col("k") <= dict_bytes // 2 + 1)
    upto = first.withColumn("upto", F.sum(size + 1).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found: dict[str, dict[str, list[str]]] = {}
    for r in upto.where(F.col("upto") <= dict_bytes).select("side", "lang", "unit", "k").collect():
        found.setdefault(r["side"], {}).setdefault(r["lang"], []).append((r["k"], r["unit"]))
    return {side: {k: " ".join(u for _, u in sorted(x, reverse=True)).encode() for k, x in by.items()} for side, by in found.items()}


def _min_margin(texts: DataFrame, halves: list[list[tuple[str, bytes]]]) -> float:
    """From every labelled text's margin, by the dictionaries of the half that
    does not hold it; right decisions count."""
    shared = texts.sparkSession.sparkContext.broadcast(halves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = [Compressors(m) if len(m) > 1 else None for m in shared.value]
        for b in batches:
            steps = Counter()
            for lang, half, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if c := compressors[1 - half]:
                    best, _, margin = c.judge(raw.encode())
                    if best == lang:
                        steps[int(margin * STEPS)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(steps), pa.int64()), pa.array(list(steps.values()), pa.int64())], ["step", "n"])

    judged = texts.select("lang", F.pmod("h", F.lit(2)).cast("int").alias("half"), "raw").mapInArrow(run, "step long, n long")
    rows = sorted((r["step"], r["n"]) for r in judged.groupBy("step").agg(F.sum("n").alias("n")).collect())
    short, seen = MARGIN_QUANTILE * sum(n for _, n in rows), 0
    for step, n in rows:
        seen += n
        if seen > short:
            return max(MIN_MARGIN, MARGIN_SHARE * step / STEPS)
    return MIN_MARGIN


def fit(docs: DataFrame, dict_bytes: int = DICT_BYTES, sample_rows: int | None = None) -> Model:
    """Learn from all labelled rows (``doc_id, text, lang``); ``sample_rows``:
    from so many different texts a language only."""
    spark = docs.sparkSession
    prepare(spark)
    before = staged_folders(spark)
    texts = _learned(docs, sample_rows)
    rows = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.sum("copies").alias("n")).collect()}
    words = staged(_counted(texts, lambda lang, raw: _words(raw)), "language-words")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "unit")
    common: dict[str, set[str]] = {}
    for r in words.select("lang", "unit", (F.col("n0") + F.col("n1")).alias("n")).withColumn("k", F.row_number().over(order)).where(F.col("k") <= PAIR_WORDS).collect():
        common.setdefault(r["lang"], set()).add(r["unit"])
    shared = spark.sparkContext.broadcast(common)

    def pairs(lang: str, raw: str) -> list[str]:
        of, w = shared.value[lang], _words(raw)
        return [f"{x} {y}" for x, y in zip(w, w[1:]) if x in of and y in of]

    made = _dictionaries(words.unionByName(_counted(texts, pairs)), dict_bytes)
    all_, *halves = [[(k, made.get(side, {})[k]) for k in sorted(made.get(side, {}), key=lambda k: (-rows[k], k))] for side in ("n", "n0", "n1")]
    model = Model(all_)
    if len(model) > 1:
        model.min_margin = _min_margin(texts, halves)
    remove_staged(spark, [f for f in staged_folders(spark) if f not in before])
    return model


class Compressors:
    def __init__(self, model: list[tuple[str, bytes]]):
        self.names = [k for k, _ in model]
        self.all = []
        for _, content in model:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.all.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (0.5 at equal sizes) and margin."""
        return self.judge(letters(text))

    def judge(self, raw: bytes) -> tuple[str, float, float]:
        """As ``classify``, of the letters of a text."""
        if not raw or not self.all:
            return UNKNOWN, 0.0, 0.0
        blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = [sum([len(c(x)) for x in blocks]) for c in self.all]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min((s for i, s in enumerate(sizes) if i != best), default=2 * sizes[best])
        margin = 1 - sizes[best] / second
        return self.names[best], min(1.0, 0.5 + 2 * margin), margin


def _least(model: list, min_margin: float | None) -> float:
    return getattr(model, "min_margin", MIN_MARGIN) if min_margin is None else min_margin


def predict(docs: DataFrame, model: list[tuple[str, bytes]], min_margin: float | None = None) -> DataFrame:
    """``doc_id, lang_pred, score, margin, rejected`` for every whole text;
    ``min_margin``: in place of the fitted one."""
    spark = docs.sparkSession
    prepare(spark)
    least = _least(model, min_margin)
    shared = spark.sparkContext.broadcast(list(model))  # dict_bytes a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Compressors(shared.value)
        for b in batches:
            got = [c.classify(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64()),
                 pa.array([x[2] for x in got], pa.float64()), pa.array([x[0] == UNKNOWN or x[2] < least for x in got], pa.bool_())],
                ["doc_id", "lang_pred", "score", "margin", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, margin double, rejected boolean")


def accepted(docs: DataFrame, model: list[tuple[str, bytes]], min_margin: float | None = None) -> DataFrame:
    """The documents with a decided language, with all their columns: only
    the texts go through Python."""
    spark = docs.sparkSession
    prepare(spark)
    least = _least(model, min_margin)
    shared = spark.sparkContext.broadcast(list(model))  # dict_bytes a language

    @F.arrow_udf("boolean")
    def decided(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = Compressors(shared.value)
        for b in texts:
            got = [c.classify(t) for t in b.to_pylist()]
            yield pa.array([x[0] != UNKNOWN and x[2] >= least for x in got], pa.bool_())

    return docs.where(decided("text"))
