"""Language identification by nearest centroids (op6).

Texts become TF-IDF vectors of hashed byte bigrams and trigrams (lower case,
letters only), of unit length. Each language is represented by several
centroids, found by spherical k-means, without those of few texts; the nearest
centroid by cosine names the language. Short texts lie farther from any centroid
than long ones, so the distance beyond which a text is rejected is learned for each
language and band of text sizes: its cosine must reach LOOSE times a low quantile
(QUANTILE) of those of the training texts nearest to that language, of its band and
of as many shorter ones (then longer ones) as hold POOL texts. A few odd training
rows, or the worst row of a large corpus, so don't move the limit.

Learned from rows with text and lang outside the held-out fold: document
frequencies and histograms of cosines over all of them, the centroids on a sample
by hash of about SAMPLE texts a language (a documented bound; the prediction
covers all rows).

Cases: a null text or one without a letter is ``und`` with score 0 and
rejected, as is every text if nothing could be learned; ties go to the
language that sorts first; rows without lang or doc_id are predicted but not
learned from; repeated documents are predicted each; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.tables import crc_mod, map_rows, ship_code

DIM = 4096
#: Texts of a language that the centroids are fitted on, about.
SAMPLE = 600
CENTROIDS = 4
FOLDS, HELD_OUT = 4, 2
#: A centroid of a smaller share of its language's texts is dropped.
LEAST_SHARE = 0.05
#: Times that odd rows are left out.
ROUNDS = 8
LOOSE = 0.35
QUANTILE = 0.1
#: Training texts that a limit rests on, at least, if there are as many.
POOL = 100
#: Steps of the histograms of cosines.
STEPS = 1000
#: Bands of text sizes: powers of two of the n-grams.
BANDS = 40
UNKNOWN = "und"

_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text."""
    raw = b" " + text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS) + b" "
    b = np.frombuffer(raw, np.uint8)
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])].astype(np.uint32)
    two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + b[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
    shift = np.uint32(32 - DIM.bit_length() + 1)
    return np.bincount(two >> shift, minlength=DIM) + np.bincount(three >> shift, minlength=DIM)


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Unit vectors, and the number of n-grams of each text."""
    out = np.zeros((len(texts), DIM), np.float32)
    sizes = []
    for k, t in enumerate(texts):
        counts = term_counts(t)
        sizes.append(int(counts.sum()))
        out[k] = np.log1p(counts) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12), sizes


def _frequencies(batches: Iterator[list]) -> Iterator[list]:
    df, n = np.zeros(DIM, np.int64), 0
    for (texts,) in batches:
        for t in texts:
            df += term_counts(t) > 0
            n += 1
    if n:
        yield [(-1, n), *enumerate(df.tolist())]


def band(n_grams: int) -> int:
    return min(BANDS - 1, n_grams.bit_length())


def _k_means(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, the nearest one of each row). Starts at the row nearest the mean,
    then at rows drawn by their squared distance from all starts (fixed seed)."""
    draw = np.random.RandomState(len(x))
    starts = [int(np.argmax(x @ x.mean(0)))]
    while len(starts) < min(k, len(x)):
        far = np.maximum(0, 1 - (x @ x[starts].T).max(1)) ** 2 + 1e-12
        starts.append(int(draw.choice(len(x), p=far / far.sum())))
    c = x[starts]
    for _ in range(12):
        near = (x @ c.T).argmax(1)
        c = np.stack([x[near == j].sum(0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c, (x @ c.T).argmax(1)


def cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids by spherical k-means. Rows of a centroid that less than LEAST_SHARE
    of all are nearest to are odd ones: the rest is clustered again without them, a
    few times at most, and what is still small then goes (the largest one never)."""
    least, rows = LEAST_SHARE * len(x), x
    for _ in range(ROUNDS):
        c, near = _k_means(rows, k)
        members = np.bincount(near, minlength=len(c))
        kept = members >= min(least, members.max())
        if kept.all():
            break
        rows = rows[kept[near]]
    return c[kept]


class Model:
    """``limits``: the least cosine by centroid and band."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, limits: np.ndarray):
        self.idf, self.langs, self.centroids, self.limits = idf, langs, centroids, limits

    def nearest(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, float]]:
        """(number, band, nearest centroid, cosine) of each text with a letter."""
        use = [k for k, t in enumerate(texts) if self.langs and has_letter(t)]
        for lo in range(0, len(use), 256):
            part = use[lo : lo + 256]
            x, sizes = vectors([texts[k] for k in part], self.idf)
            for k, n, row in zip(part, sizes, x @ self.centroids.T):
                j = int(row.argmax())
                yield k, band(n), j, float(min(1.0, max(0.0, row[j])))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text."""
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        for k, b, j, score in self.nearest(texts):
            out[k] = (self.langs[j], score, score < self.limits[j, b])
        return out



def _histograms(rows: DataFrame, model: Model) -> dict[str, np.ndarray]:
    """For each language the texts of ``rows`` nearest to it by band and step of the
    cosine. Texts without a letter don't count."""
    sent = rows.sparkSession.sparkContext.broadcast((model.idf, model.langs, model.centroids, model.limits))

    def part(batches: Iterator[list]) -> Iterator[list]:
        model, counts = Model(*sent.value), Counter()
        for (texts,) in batches:
            counts.update((model.langs[j], b, int(score * (STEPS - 1))) for _, b, j, score in model.nearest(texts))
        yield [(*at, n) for at, n in counts.items()]

    found = map_rows(rows.select("text"), part, "lang string, band int, step int, n long")
    out = {lang: np.zeros((BANDS, STEPS), np.int64) for lang in model.langs}
    # At most STEPS rows for each language and band.
    for lang, b, step, n in found.groupBy("lang", "band", "step").agg(F.sum("n")).collect():
        out[lang][b, step] = n
    return out


def limits_of(counts: np.ndarray) -> np.ndarray:
    """The least cosine accepted by band, from a language's histograms."""
    sizes = counts.sum(1)
    out = np.zeros(BANDS)
    if not sizes.any():
        return out
    for b in range(BANDS):
        pool, seen = counts[b].copy(), sizes[b]
        for near in [*range(b - 1, -1, -1), *range(b + 1, BANDS)]:
            if seen >= POOL:
                break
            pool, seen = pool + counts[near], seen + sizes[near]
        step = int(np.searchsorted(np.cumsum(pool), max(1, QUANTILE * seen)))
        out[b] = LOOSE * step / (STEPS - 1)
    return out


def fit(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    """The model of ``docs`` (doc_id, text, lang)."""
    ship_code(docs.sparkSession)
    rows = docs.select(
        docs["doc_id"].cast("long"), docs["text"].cast("string"), docs["lang"].cast("string")
    ).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod("doc_id", FOLDS) != HELD_OUT)
    )
    found = {r[0]: r[1] for r in map_rows(rows.select("text"), _frequencies, "dim int, df long").groupBy("dim").sum("df").collect()}
    n = found.pop(-1, 0)
    df = np.array([found.get(d, 0) for d in range(DIM)], float)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    counts = rows.groupBy("lang").count().collect()  # one row for each language
    if not counts:
        return Model(idf, [], np.zeros((0, DIM), np.float32), np.zeros((0, BANDS)))
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample / r["count"]))])
    part = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    picked = rows.where(part < rates[F.col("lang")])

    def clustered(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x, _ = vectors(pdf.sort_values("doc_id")["text"].tolist(), idf)
        return pd.DataFrame({"lang": key[0], "centroid": [y.astype("<f4").tobytes() for y in cluster(x, k)]})

    fitted = picked.groupBy("lang").applyInPandas(clustered, "lang string, centroid binary")
    out = sorted(fitted.collect())  # k rows for each language
    if not out:
        return Model(idf, [], np.zeros((0, DIM), np.float32), np.zeros((0, BANDS)))
    c = np.stack([np.frombuffer(r["centroid"], "<f4") for r in out])
    langs = [r["lang"] for r in out]
    found = _histograms(rows, Model(idf, langs, c, np.zeros((len(langs), BANDS))))
    by_lang = {lang: limits_of(counts) for lang, counts in found.items()}
    return Model(idf, langs, c, np.stack([by_lang[lang] for lang in langs]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score, rejected."""
    sent = docs.sparkSession.sparkContext.broadcast((model.idf, model.langs, model.centroids, model.limits))

    def predicted(batches: Iterator[list]) -> Iterator[list]:
        for ids, out, texts in batches:
            yield [(i, h, *p) for i, h, p in zip(ids, out, Model(*sent.value).predict(texts))]

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        docs["text"].cast("string").alias("text"),
    )
    return map_rows(rows, predicted, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, whose language is recognised."""
    ship_code(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.idf, model.langs, model.centroids, model.limits))

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return pd.Series([not r for _, _, r in Model(*sent.value).predict(texts.tolist())], dtype=bool)

    return docs.where(known(docs["text"].cast("string")))
