"""Language of a text by the nearest of several centroids per language.

A text is a normalised TF-IDF vector over hashed character n-grams. Every learned language has
a few centroids, found by clustering unit vectors (so that, say, very short and very long texts
of one language need not share one). A text gets the language of the centroid with the highest
cosine; it is rejected when it lies further from that centroid than the texts it was made of.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchwright.llm.texts import slices, tidy
from matchwright.session import stage

#: Buckets of the hashed n-grams, and the lengths of the n-grams.
BUCKETS, LENGTHS = 1 << 15, (1, 2, 3)
#: Code points looked at in one step, so that a very long text stays bounded.
STEP = 1 << 20
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Which code points of the basic plane are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


def _letter_mask(points: np.ndarray) -> np.ndarray:
    mask = _letters()[np.minimum(points, 0xFFFF)]
    beyond = np.flatnonzero(points > 0xFFFF)
    mask[beyond] = [chr(c).isalpha() for c in points[beyond].tolist()]
    return mask


def ngram_counts(text: str | None) -> np.ndarray:
    """How often the n-grams of each bucket come in the whole text; zeros if it has no letter.

    The text is lower-cased, and every run of other characters than letters is one space, also
    before the first and after the last letter.
    """
    counts = np.zeros(BUCKETS, np.int64)
    if not text:
        return counts
    tail, some = np.array([32], np.uint32), False
    keep = max(LENGTHS) - 1
    for at in range(0, len(text) + 1, STEP):
        # one space closes the last step
        part = text[at : at + STEP].lower() + (" " if at + STEP > len(text) else "")
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").copy()
        mask = _letter_mask(points)
        some = some or bool(mask.any())
        points[~mask] = 32
        points = np.concatenate((tail, points))
        points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
        fresh = len(tail) if at else 0  # n-grams that end in the tail of an earlier step are counted already
        wide = points.astype(np.uint64)
        for n in LENGTHS:
            if len(points) < n:
                continue
            code = np.full(len(points) - n + 1, n, np.uint64)
            for k in range(n):
                code = (code ^ wide[k : len(points) - n + 1 + k]) * MIX[k]
                code ^= code >> np.uint64(29)
            first = max(0, fresh - n + 1)
            counts += np.bincount((code[first:] >> np.uint64(20)).astype(np.int64) % BUCKETS, minlength=BUCKETS)
        tail = points[-keep:]
    return counts if some else np.zeros(BUCKETS, np.int64)


def weigh(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and their weights, as a vector of length 1 (no bucket: empty)."""
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    return at, (value / max(np.linalg.norm(value), 1e-12)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """idf per bucket; centroids as columns (buckets x centroids), their language and their reach (1 - cosine)."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: tuple[str, ...]
    reach: np.ndarray

    def nearest(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine (0 to 1) and whether the text lies beyond the centroid's reach."""
        counts = ngram_counts(text)
        at, value = weigh(counts, self.idf)
        if not len(at) or not self.langs:
            return UNKNOWN, 0.0, True
        cosines = value @ self.centroids[at]
        best = int(np.argmax(cosines))  # ties: the first, in order of language and cluster
        near = min(1.0, max(0.0, float(cosines[best])))
        return self.langs[best], near, bool(1 - near > self.reach[best])


def folded(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def _documents_per_bucket(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Over all texts with a letter: how many have each bucket, and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text"):
                    has = ngram_counts(text.as_py()) > 0
                    seen[:-1] += has
                    seen[-1] += bool(has.any())
                tidy()
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in counted.collect():  # BUCKETS + 1 rows at most
        df[bucket] = n
    return df[:-1], int(df[-1])


def bounded_sample(labelled: DataFrame, per_lang: int) -> DataFrame:
    """lang and text of the `per_lang` distinct rows of each language with the least hash."""
    hashed = labelled.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    least = (
        hashed.select("lang", "h").distinct()
        .withColumn("rank", F.expr("row_number() over (partition by lang order by h)"))
        .where(F.col("rank") <= per_lang)
        .groupBy("lang").agg(F.max("h").alias("most"))
    )
    # one row per language, as the model has; a join by language would send each one's texts to one task
    return hashed.join(F.broadcast(least), "lang").where("h <= most").dropDuplicates(["lang", "h"]).select("lang", "text")


def _clusters(rows: np.ndarray, k: int, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means on unit rows: unit centroids and the cosine of each row to its own.

    It starts from the first row and then, again and again, the row least like all chosen
    ones, so it draws nothing at random; a cluster that runs empty goes.
    """
    chosen = [0]
    best = rows @ rows[0]
    while len(chosen) < min(k, len(rows)):
        far = int(np.argmin(best))
        chosen.append(far)
        best = np.maximum(best, rows @ rows[far])
    centres, own = rows[chosen], None
    for _ in range(rounds):
        cosines = rows @ centres.T
        now = np.argmax(cosines, axis=1)
        if own is not None and np.array_equal(now, own):
            break
        own = now
        sums = np.stack([rows[own == c].sum(axis=0) for c in range(len(centres)) if (own == c).any()])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        own = None if len(centres) < len(cosines[0]) else own
    cosines = rows @ centres.T
    return centres, np.stack((np.argmax(cosines, axis=1), cosines.max(axis=1)), axis=1)


def fit(labelled: DataFrame, clusters: int = 4, per_lang: int = 800, quantile: float = 0.99, slack: float = 1.25) -> Model:
    """A model from doc_id, lang and text of labelled rows (rows without lang are not used).

    The idf is counted over all rows. Clusters are fitted on at most `per_lang` distinct rows
    of each language, those with the least hash. A centroid reaches `slack` times as far as
    `quantile` of its rows. What comes to the driver is BUCKETS figures and, per language,
    at most `clusters` centroids of BUCKETS figures. Texts without a letter teach nothing; no
    usable row gives a model without languages.
    """
    rows = labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    ).dropna(subset=["lang", "text"])
    seen, total = _documents_per_bucket(rows)
    idf = np.log((1 + total) / (1 + seen)) + 1
    given = rows.sparkSession.sparkContext.broadcast(idf)  # BUCKETS figures

    def cluster(table: pa.Table) -> pa.Table:
        vectors = []
        for text in table.column("text"):
            at, value = weigh(ngram_counts(text.as_py()), given.value)
            if len(at):
                vectors.append(np.zeros(BUCKETS, np.float32))
                vectors[-1][at] = value
        found = {"lang": [], "cluster": [], "reach": [], "centroid": []}
        if vectors:
            dense = np.stack(vectors)
            dense = dense[np.lexsort(dense[:, :64].T)]  # the order in which rows arrive plays no part
            centres, own = _clusters(dense, clusters)
            for c, centre in enumerate(centres):
                near = own[own[:, 0] == c, 1]
                if len(near):
                    found["lang"].append(table.column("lang")[0].as_py())
                    found["cluster"].append(c)
                    found["reach"].append(float(slack * np.quantile(1 - near, quantile)) + 1e-6)
                    found["centroid"].append(centre.astype(np.float32))
        return pa.table(found, pa.schema([("lang", pa.string()), ("cluster", pa.int32()), ("reach", pa.float64()), ("centroid", pa.list_(pa.float32()))]))

    made = bounded_sample(rows, per_lang).groupBy("lang").applyInArrow(cluster, "lang string, cluster int, reach double, centroid array<float>")
    found = stage(made, "language-centroids").orderBy("lang", "cluster").collect()
    centroids = np.array([r.centroid for r in found], np.float32).reshape(len(found), BUCKETS).T.copy()
    return Model(idf, centroids, tuple(r.lang for r in found), np.array([r.reach for r in found]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row, from its text alone.

    A null text or one without a letter is `und` with score 0 and rejected, as is every text
    where nothing was learned. `lang_pred` of a rejected text is still the nearest language.
    Equal texts get equal answers; repeated rows give a row each; other columns are not read.
    """
    given = docs.sparkSession.sparkContext.broadcast(model)  # bounded as in fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [given.value.nearest(t.as_py()) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_())))],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )
                tidy()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, folds: int = 5, **fitting) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: learned from the rows outside fold 0, applied to every row."""
    model = fit(docs.where(folded(F.col("doc_id"), folds) != 0).select("doc_id", "lang", "text"), **fitting)
    out = predict(docs, model)
    return out.select("doc_id", (folded(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score", "rejected")
