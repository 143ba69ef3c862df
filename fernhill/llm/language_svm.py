"""Language identification in two levels with linear support vector machines.

The language family is predicted first; within it, one-versus-one machines separate the
related languages. Each machine is a linear L2-regularised squared-hinge SVM over the
hashed one- to three-character grams of a whole text, with root counts scaled to length one.
Families themselves are told apart one-versus-one as well.

The machines are trained as Spark tasks, one per pair, on about ``sample_rows`` documents per language
chosen by hash (a documented bound); everything is scored on whole texts.

Defined cases: `und` with score 0 if a text is null or has no letter, or if nothing was learned; a
null language trains nothing; with one language, every text with a letter gets it with score 1; a
language that is in no family of the table is a family by itself; repeated rows count and are predicted each; other
columns, whatever their names, are ignored. Memory is bounded by the longest text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .charvec import char_slices, shifted
from .common import settle
from .textvec import mix, places

DIMENSIONS = 4096

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}


@dataclass(frozen=True)
class LanguageParams:
    sample_rows: int = 1500
    penalty: float = 1e-3
    sharpness: float = 4.0


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], f"only-{lang}")


def gram_vectors(symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of unit length: root counts of hashed grams of one to three characters."""
    row, place = places(counts)
    code = np.zeros(len(symbols), np.uint64)
    total = np.zeros((len(counts), DIMENSIONS), np.float32)
    for back in range(3):
        code |= shifted(symbols, place, back) << np.uint64(8 * back)
        at = (mix(code + np.uint64(back + 1 << 32)) >> np.uint64(52)).astype(np.int64)
        total += np.bincount(row * DIMENSIONS + at, minlength=total.size).reshape(total.shape)
    total = np.sqrt(total)
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)


def train_svm(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Weights and intercept by Newton steps, each solved by conjugate gradients; classes weigh alike."""
    x = np.c_[x, np.ones(len(x), np.float32)].astype(np.float64)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = np.zeros(x.shape[1])
    for _ in range(12):
        margin = 1 - y * (x @ w)
        active = margin > 0
        xa, ca = x[active], weight[active]
        gradient = penalty * w - xa.T @ (ca * y[active] * margin[active])
        step, r = np.zeros_like(w), -gradient
        d, rr = r.copy(), r @ r
        for _ in range(40):
            if rr < 1e-14:
                break
            hd = penalty * d + xa.T @ (ca * (xa @ d))
            a = rr / (d @ hd)
            step, r = step + a * d, r - a * hd
            rr, old = r @ r, rr
            d = r + rr / old * d
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: By pair of families or of languages of one family: weights that are positive for the first.
    machines: dict[tuple[str, str], np.ndarray]
    sharpness: float = 4.0

    def _best(self, x: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Place of the best name per row and its mean chance against the others."""
        chance = np.zeros((len(x), len(names)))
        for a, b in combinations(range(len(names)), 2):
            w = self.machines.get((names[a], names[b]))
            p = 0.5 if w is None else 1 / (1 + np.exp(-np.clip(self.sharpness * (x @ w[:-1] + w[-1]), -30, 30)))
            chance[:, a] += p
            chance[:, b] += 1 - p
        best = chance.argmax(axis=1)
        return best, chance[np.arange(len(x)), best] / max(1, len(names) - 1) if len(names) > 1 else np.ones(len(x))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(x), np.zeros(len(x))
        families = sorted({family_of(x) for x in self.languages})
        family, score = self._best(x, families)
        names = np.full(len(x), "und", object)
        for n, own in enumerate(families):
            rows = np.flatnonzero(family == n)
            members = [lang for lang in self.languages if family_of(lang) == own]
            best, chance = self._best(x[rows], members)
            names[rows] = np.array(members, object)[best]
            score[rows] *= chance
        return names.tolist(), score


def train(docs: DataFrame, trains: Column, params: LanguageParams = LanguageParams(), id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> LanguageModel:
    """Learn from the rows for which the column ``trains`` holds."""
    has_letter = F.col(text_col).rlike(r"\p{L}")
    known = docs.where(trains & F.col(lang_col).isNotNull() & has_letter).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)).alias("h"))
    sizes = {r.lang: r["n"] for r in docs.where(trains & F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if len(languages) < 2:
        return LanguageModel(languages, {}, params.sharpness)
    family = {lang: family_of(lang) for lang in languages}
    problems = list(combinations(sorted(set(family.values())), 2)) + [p for p in combinations(languages, 2) if family[p[0]] == family[p[1]]]
    # a row of the sample takes part in each problem that its family or language is in, as +1 or -1
    parts = [(lang, n, 1 if side == pair[0] else -1) for lang in languages for n, pair in enumerate(problems) for side in (family[lang], lang) if side in pair]
    limit = F.create_map(*(F.lit(v) for lang in languages for v in (lang, int(min(1.0, params.sample_rows / sizes[lang]) * (1 << 30)))))
    roles = F.create_map(*(x for lang in languages for x in (F.lit(lang), F.array(*(
        F.struct(F.lit(n).alias("problem"), F.lit(y).alias("y")) for own, n, y in parts if own == lang)))))
    sample = known.where(F.col("h") < limit[F.col("lang")])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, symbols, counts in char_slices(batch.column(1)):
                x = gram_vectors(symbols, counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([v.tobytes() for v in x], pa.binary())], names=["lang", "x"])

    measured = settle(sample.select("lang", "text").mapInArrow(vectors, "lang string, x binary"), "language-sample")

    def solve(table: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float32).reshape(-1, DIMENSIONS)
        w = train_svm(x, table["y"].to_numpy().astype(np.float64), params.penalty)
        return pa.table({"problem": pa.array([table["problem"][0].as_py()], pa.int32()), "w": pa.array([w.astype("<f8").tobytes()], pa.binary())})

    tasks = measured.select("x", F.explode(roles[F.col("lang")]).alias("p")).select("x", "p.problem", "p.y")
    solved = tasks.groupBy("problem").applyInArrow(solve, "problem int, w binary").collect()  # one row per pair of languages
    return LanguageModel(languages, {problems[r.problem]: np.frombuffer(r.w, "<f8") for r in solved}, params.sharpness)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            for i, j, symbols, counts in char_slices(batch.column(1)):
                names, score = shared.value.predict(gram_vectors(symbols, counts))
                some = letters[i:j]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([n if s else "und" for n, s in zip(names, some, strict=True)], pa.string()), pa.array(np.where(some, score, 0.0))],
                    names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(apply, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
