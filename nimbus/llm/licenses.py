"""Operator 7: licence scan with inheritance along directories.

*Statements.* Every line of a file is a sparse TF-IDF vector (words of letters
and digits, weighed by their rarity among the templates) and is compared to
each template by cosine; the best one of ``THRESHOLD`` or more names the
file's licence. By Cauchy-Schwarz a line's cosine is at most the weight share
of the template terms it holds, so lines without any *strong* term (see
``strong_terms``) need no vector.

*Headers and texts.* The titles, tags, statements, headers and licence texts
of ``license_texts`` are compared in the same way, with weights of their own,
to every window of as many words, wherever lines break; titles to whole lines.
Titles and tags need all their terms (a German line may be "Mit.").
A header or text of ``LONG`` words or more goes before any statement (an
"All rights reserved." may stand in many licences), a statement before a bare
title; else the best score counts.

*Licence files.* A file whose words are at least half its best statement, or
that starts with the opening of a licence's text, speaks for its directory; of
several in one directory the first path counts. A window's lines count as a
statement's words, up to four times the window's.

*Inheritance.* A file without a statement takes the licence of its nearest
ancestor directory that has one. Ancestors are computed for each different
directory, not for each file, and joined by path.

Defined results: null and empty texts have no statement (but may inherit);
lines with equal cosines rank by line number, templates by name; a null path
inherits nothing; repeated files give repeated rows; an empty table gives no
rows; other columns than those named are ignored. All steps are DataFrame
operations; a third of all files in one directory only makes a hot join key.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import prepare, staged
from nimbus.llm.license_texts import PATTERNS

THRESHOLD = 0.8
FREQUENT = {"and", "any", "are", "for", "from", "not", "other", "our", "that", "the", "this", "use", "with", "work", "works", "you", "your"}
WHOLE = {"title", "tag"}  # short patterns, all of whose terms are needed
LONG = 20  # words from which a text goes before statements
# Statements by which licences are commonly declared.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "Proprietary": "All rights reserved.",
}


def terms(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def weights(templates: dict[str, str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the templates' terms, and of any other."""
    n = len(templates)
    df = Counter(t for text in templates.values() for t in set(terms(text)))
    return {t: math.log((1 + n) / (1 + c)) + 1 for t, c in df.items()}, math.log(1 + n) + 1


def strong_terms(templates: dict[str, str], threshold: float = THRESHOLD) -> set[str]:
    """Terms one of which every line of ``threshold`` or more holds: the
    others, taken together, cannot reach it for any template."""
    idf, _ = weights(templates)
    vectors = {k: {t: c * idf[t] for t, c in Counter(terms(x)).items()} for k, x in templates.items()}
    weak: set[str] = set()
    # Short and shared terms first: they are the frequent words.
    for t in sorted(idf, key=lambda t: (len(t), idf[t], t)):
        if all(sum(w * w for x, w in v.items() if x in weak | {t}) < (threshold * threshold - 1e-9) * sum(w * w for w in v.values()) for v in vectors.values()):
            weak.add(t)
    return set(idf) - weak


def few_strong_terms(patterns: list[str], threshold: float = THRESHOLD) -> set[str]:
    """As ``strong_terms``, but few: those that most texts still need."""
    idf, _ = weights({str(i): x for i, x in enumerate(patterns)})
    vectors = [{t: (c * idf[t]) ** 2 for t, c in Counter(terms(x)).items()} for x in patterns]
    limit = threshold * threshold - 1e-9
    strong: set[str] = set()
    while open_ := [v for v in vectors if sum(w for t, w in v.items() if t not in strong) >= limit * sum(v.values())]:
        gain = Counter()
        for v in open_:
            for t, w in v.items():
                if t not in strong:
                    gain[t] += w / sum(v.values())
        # Words that any text holds come last.
        strong.add(max(sorted(gain), key=lambda t: (len(t) > 2 and t not in FREQUENT and not t.isdigit(), gain[t])))
    return strong


class Windows:
    """The best pattern (``license, kind, text``) of a whole text."""

    def __init__(self, patterns: list[tuple[str, str, str]], threshold: float):
        self.threshold = threshold
        self.idf, self.other = weights({str(i): x for i, (_, _, x) in enumerate(patterns)})
        self.patterns = []
        for name, kind, x in patterns:
            count = Counter(terms(x))
            vector = {t: c * self.idf[t] for t, c in count.items()}
            self.patterns.append((name, kind, sum(count.values()), vector, math.sqrt(sum(w * w for w in vector.values()))))
        self.at = {t: i for i, t in enumerate(self.idf)}
        self.share = np.array([[(vector.get(t, 0.0) / norm) ** 2 for t in self.idf] for _, _, _, vector, norm in self.patterns])

    def best(self, text: str) -> tuple[int, float, int, str, bool] | None:
        """Rank, score, line, license and whether the file is a licence file."""
        lines = [terms(x) for x in text.split("\n")]
        said = [t for x in lines for t in x]
        # By Cauchy-Schwarz no window passes without so much of a pattern's weight in the text.
        held = self.share[:, [self.at[t] for t in set(said) if t in self.at]].sum(1)
        able = np.flatnonzero(held >= self.threshold ** 2 - 1e-6)
        if not len(able):
            return None
        first = np.cumsum([0] + [len(x) for x in lines])
        line_of = np.repeat(np.arange(len(lines)), np.diff(first))
        at: dict[str, int] = {}
        codes = np.array([at.setdefault(t, len(at)) for t in said])
        idf = np.array([self.idf.get(t, self.other) for t in at])
        squares = np.concatenate([[0.0], np.cumsum(idf[codes] ** 2)])
        found = None
        for name, kind, size, vector, norm in (self.patterns[i] for i in able):
            own = np.array([vector.get(t, 0.0) for t in at]) * idf
            dots = np.concatenate([[0.0], np.cumsum(own[codes])])
            if kind == "title":
                start, end = first[:-1], first[1:]
            else:
                start = np.arange(max(1, len(said) - size + 1))
                end = np.minimum(start + size, len(said))
            dot = dots[end] - dots[start]
            # A term's weight in a window is at least as if its occurrences were different terms.
            bound = dot / (norm * np.sqrt(np.maximum(squares[end] - squares[start], 1e-12)))
            for i in np.flatnonzero(bound >= self.threshold - 1e-6):
                a, b = int(start[i]), int(end[i])
                seen, tf = np.unique(codes[a:b], return_counts=True)
                score = round(float(dot[i] / (norm * math.sqrt(((tf * idf[seen]) ** 2).sum()))), 6)
                if score < self.threshold or (kind in WHOLE and not vector.keys() <= set(said[a:b])):
                    continue
                rank = 0 if kind == "title" else 2 if size >= LONG else 1
                block = min(int(first[line_of[b - 1] + 1] - first[line_of[a]]), 4 * size)
                covers = 2 * block >= len(said) or (kind == "opening" and a <= size)
                key = (-rank, -score, int(line_of[a]), name, not covers)
                found = key if found is None or key < found else found
        return found and (-found[0], -found[1], found[2], found[3], not found[4])


def windows(some: DataFrame, patterns: list[tuple[str, str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """``path, key, rank, score, line, license, covers``: the best pattern of
    each text (``path, key, text``) that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan_ = Windows(patterns, threshold)
        for b in batches:
            rows = [(p, k, *hit) for p, k, x in zip(*(c.to_pylist() for c in b.columns), strict=True) if (hit := scan_.best(x))]
            if rows:
                types = [pa.string(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["path", "key", "rank", "score", "line", "license", "covers"])

    return some.select("path", "key", "text").mapInArrow(run, "path string, key long, rank int, score double, line int, license string, covers boolean")


def _any_of(words: set[str]) -> str:
    """A regular expression for the words, by their first letters."""
    by: dict[str, list[str]] = {}
    for w in sorted(words):
        by.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{k}(?:{'|'.join(v)})" for k, v in by.items())


def _words(col: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "), " "), lambda t: t != "")


def statements(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``path, key, license, score, covers`` of each file with a statement;
    ``key``: hash of the text (files are told apart by path and text)."""
    patterns = PATTERNS if templates is None else []
    templates = TEMPLATES if templates is None else templates
    spark = files.sparkSession
    prepare(spark)
    idf, other = weights(templates)
    strong = "|".join(sorted(strong_terms(templates, threshold)))
    vectors = [(k, t, float(c * idf[t]), math.sqrt(sum((n * idf[x]) ** 2 for x, n in Counter(terms(text)).items())))
               for k, text in templates.items() for t, c in Counter(terms(text)).items()]
    # The templates are a few dozen rows.
    template = F.broadcast(spark.createDataFrame(vectors, "license string, term string, w double, t_norm double"))
    idf_rows = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    mark = f"(?i)(?<![a-z0-9])({strong})(?![a-z0-9])"
    marks = _any_of(strong_terms(templates, threshold) | few_strong_terms([x for _, _, x in patterns], threshold))
    some = staged(files.where(F.col("text").rlike(f"(?i)(?<![a-z0-9])({marks})(?![a-z0-9])")).select("path", F.xxhash64("text").alias("key"), "text").distinct(), "licence-candidates")
    lines = (some.select("path", "key", F.size(_words(F.col("text"))).alias("n_words"), F.posexplode(F.split("text", "\n")).alias("line", "said"))
             .where(F.col("said").rlike(mark)))
    counted = (lines.select("path", "key", "n_words", "line", F.explode(_words(F.col("said"))).alias("term"))
               .groupBy("path", "key", "n_words", "line", "term").agg(F.count(F.lit(1)).alias("tf"))
               .join(idf_rows, "term", "left").withColumn("lw", F.col("tf") * F.coalesce("idf", F.lit(other))))
    at = ["path", "key", "n_words", "line"]
    norms = counted.groupBy(*at).agg(F.sqrt(F.sum(F.col("lw") * F.col("lw"))).alias("norm"), F.sum("tf").alias("line_words"))
    dots = counted.join(template, "term").groupBy(*at, "license", "t_norm").agg(F.sum(F.col("lw") * F.col("w")).alias("dot"))
    scored = dots.join(norms, at).withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 6)).where(F.col("score") >= threshold)
    found = scored.select("path", "key", F.lit(1).alias("rank"), "score", "line", "license", (2 * F.col("line_words") >= F.col("n_words")).alias("covers"))
    if patterns:
        found = found.unionByName(windows(some, patterns, threshold))
    best = found.groupBy("path", "key").agg(F.min(F.struct((-F.col("rank")).alias("rank"), (-F.col("score")).alias("score"), "line", "license", (~F.col("covers")).alias("partly"))).alias("b"))
    return best.select("path", "key", F.col("b.license").alias("license"), (-F.col("b.score")).alias("score"), (~F.col("b.partly")).alias("covers"))


def directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def inherited(directories: DataFrame, licence_files: DataFrame) -> DataFrame:
    """``dir, from_dir, dir_license``: the nearest ancestor (itself first) of
    each directory that has a licence file (``path, license``)."""
    speaks = (licence_files.withColumn("from_dir", directory(F.col("path"))).groupBy("from_dir")
              .agg(F.min(F.struct("path", "license")).alias("f")).select("from_dir", F.col("f.license").alias("dir_license")))
    parts = F.split("dir", "/")
    ways = directories.select("dir").distinct().select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("from_dir")))).alias("a"))
    return (ways.select("dir", "a.depth", "a.from_dir").join(speaks, "from_dir").groupBy("dir")
            .agg(F.max(F.struct("depth", "from_dir", "dir_license")).alias("m")).select("dir", "m.from_dir", "m.dir_license"))


def scan(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``path, doc_id, license, origin, score, from_dir`` for every file
    (``path, doc_id, text``); origin: own, inherited or null."""
    own = staged(statements(files, templates, threshold), "licence-statements")
    rows = files.select("path", "doc_id", F.xxhash64("text").alias("key"), directory(F.col("path")).alias("dir"))
    above = inherited(rows.where(F.col("dir").isNotNull()), own.where("covers").select("path", "license"))
    joined = rows.join(own.select("path", "key", "license", "score"), ["path", "key"], "left").join(above, "dir", "left")
    has = F.col("license").isNotNull()
    return joined.select("path", "doc_id", F.coalesce("license", "dir_license").alias("license"),
                         F.when(has, "own").when(F.col("dir_license").isNotNull(), "inherited").alias("origin"), "score",
                         F.when(~has, F.col("from_dir")).alias("from_dir"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: below the source, directories for the
    thousand, the hundred and the ten of the id, of which a document stands
    below the first none, one, two or three (its id modulo 4). So licence
    files stand in ancestors of all distances."""
    levels = [F.coalesce("source", F.lit(""))] + [F.coalesce(F.floor(F.col("doc_id") / n).cast("string"), F.lit("")) for n in (1000, 100, 10)]
    dirs = [F.concat_ws("/", *levels[:k]) for k in (1, 2, 3, 4)]
    of = F.pmod(F.col("doc_id"), F.lit(4))
    where = F.when(of == 0, dirs[0]).when(of == 2, dirs[2]).when(of == 3, dirs[3]).otherwise(dirs[1])
    return docs.select("doc_id", "text", F.concat_ws("/", where, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("path"))
