"""Toxicity by a convolutional text classifier.

Words are embedded as the sum of hashed features: the word and its first letters, so that unseen forms of a
word share what is known of it. Filters of several widths slide over the words, each filter's highest answer over the
text goes to a logistic output. The network is trained on all labelled documents that may be learnt from: in rounds, in
each of which tasks train copies on their own documents and the copies are averaged. It scores whole texts on the
executors. Thresholds for removal are calibrated by language on documents kept out of the fit.

A filter is linear in the embeddings, so its answer at a place is a sum of one table row for each word it covers; the
rows of a word are looked up once per worker.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm.common import by_batch, give_back, likely_in, map_frames, stage, whole
from wordtide.operators.word_vectors import one_thread

BUCKETS = 1 << 15
WIDTHS = (1, 2, 3)
FILTERS = 12
DIM = 16
# Up to ``ALONE`` documents are fitted in one task. More are dealt to tasks of about ``CELL`` each, in ``ROUNDS`` rounds.
ALONE, CELL, ROUNDS = 4_000, 2_000, 6
# Every document is fitted once at least, and ``EPOCHS`` times if there are no more than ``ALONE``.
EPOCHS = 6
# Rows of the embeddings that are averaged together.
AVERAGED = 1_024
# Share of clean documents that a threshold may reject at most.
CLEAN_LOSS = 0.005
REMEMBERED = 150_000

_word = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _word.findall(text.lower())


def features_of(word: str, buckets: int = BUCKETS) -> list[int]:
    """Buckets of the word and of its beginnings of three to five letters."""
    parts = [word]
    for n in (3, 4, 5):
        if len(word) > n:
            parts.append(word[:n] + "~")
    return [crc32(p.encode()) % buckets for p in parts]


@dataclass
class TextCnn:
    """Parameters: embeddings, filters by width (width, dim, filters), filter biases, output weights and bias."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    known: dict[str, int] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = 7, buckets: int = BUCKETS, dim: int = DIM, widths=WIDTHS, filters: int = FILTERS) -> TextCnn:
        random = np.random.default_rng(seed)
        return cls(
            (random.normal(0, 0.1, (buckets, dim))).astype("f4"),
            [random.normal(0, (w * dim) ** -0.5, (w, dim, filters)).astype("f4") for w in widths],
            [np.zeros(filters, "f4") for _ in widths],
            random.normal(0, 0.3, len(widths) * filters).astype("f4"),
            0.0,
        )

    def copy(self) -> TextCnn:
        """A network of its own, without the remembered words."""
        return TextCnn(self.embedding.copy(), [f.copy() for f in self.filters], [b.copy() for b in self.biases], self.out.copy(), self.bias)

    def forget(self) -> None:
        """Drop the remembered words."""
        self.known.clear()
        self.tables = None

    # Scoring. ``tables`` holds for every remembered word its part of each filter at each place of its window.

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        at = len(self.known)
        if not at:
            self.stacked = np.concatenate([f[k] for f in self.filters for k in range(len(f))], axis=1)
            self.tables = np.zeros((REMEMBERED, self.stacked.shape[1]), "f4")
        lists = [features_of(w, len(self.embedding)) for w in words]
        ends = np.cumsum([len(x) for x in lists])
        rows = self.embedding[np.fromiter((b for x in lists for b in x), "i8", int(ends[-1]))]
        while at + len(words) > len(self.tables):
            self.tables = np.concatenate((self.tables, np.zeros_like(self.tables)))
        self.tables[at : at + len(words)] = np.add.reduceat(rows, np.concatenate(([0], ends[:-1])), axis=0) @ self.stacked
        self.known.update(zip(words, range(at, at + len(words))))

    def scores(self, texts: Iterable[str]) -> np.ndarray:
        return np.array([s for some in _portions(texts) for s in self._scores(some)])

    def _scores(self, texts: list[str]) -> list[float]:
        cut = [words_of(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set().union(*cut)
        self._learn(list(new))
        return [self._score(np.fromiter(map(self.known.__getitem__, w), "i8", len(w))) for w in cut]

    def _score(self, ids: np.ndarray) -> float:
        n, highest, column = self.out.shape[0] // len(self.filters), [], 0
        best = [np.full(n, -np.inf, "f4") for _ in self.filters]
        overlap = max(len(f) for f in self.filters) - 1
        for start in range(0, max(1, len(ids)), 1 << 15):
            rows = self.tables[ids[start : start + (1 << 15) + overlap]] if len(ids) else np.zeros((0, n), "f4")
            column = 0
            for which, f in enumerate(self.filters):
                w = len(f)
                if len(rows) >= w:
                    answer = rows[: len(rows) - w + 1, column : column + n].copy()
                    for k in range(1, w):
                        answer += rows[k : len(rows) - w + 1 + k, column + k * n : column + (k + 1) * n]
                    best[which] = np.maximum(best[which], answer.max(0))
                column += w * n
        for top, b in zip(best, self.biases):
            # A text shorter than the filter gives no answer: the filter is silent.
            highest.append(np.where(np.isfinite(top), np.maximum(top + b, 0), 0))
        return float(1 / (1 + np.exp(-np.clip(np.concatenate(highest) @ self.out + self.bias, -30, 30))))

    # Training.

    def fit(
        self, texts: Iterable[list[str]], labels: np.ndarray | list, epochs: int = EPOCHS, rate: float = 0.02, seed: int = 7, decay: float = 1e-5, ones: float | None = None
    ) -> np.ndarray:
        """Adam over single documents' gradients, summed over small batches; labels are weighted to equal shares.

        Only the place of each filter's highest answer gets a gradient, so a step touches few embeddings. Which of them
        were touched is returned. ``texts`` may be an iterator that adds to ``labels``; ``ones`` is the share of label 1,
        if that of these texts is not the one to weight by.
        """
        random = np.random.default_rng(seed)
        number: dict[str, int] = {}
        ids = [np.fromiter((number.setdefault(w, len(number)) for w in t), "i4", len(t)) for t in texts]
        labels = np.asarray(labels, "f4")
        lists = [features_of(w, len(self.embedding)) for w in number]
        most = 4
        features = np.full((len(lists), most), len(self.embedding), "i8")
        for k, some in enumerate(lists):
            features[k, : len(some)] = some
        table = np.vstack((self.embedding, np.zeros((1, self.embedding.shape[1]), "f4")))
        ones = labels.mean() if ones is None else ones
        weight = np.where(labels == 1, 0.5 / max(ones, 1e-6), 0.5 / max(1 - ones, 1e-6))
        sizes = [len(f) for f in self.filters]
        n = self.filters[0].shape[2]
        squares = np.zeros(table.shape[0], "f4")
        dense = [*self.filters, *self.biases, self.out]
        first, second, steps = [np.zeros_like(x) for x in dense], [np.zeros_like(x) for x in dense], 0
        bias_square = 0.0
        for epoch in range(epochs):
            order = random.permutation(len(ids))
            for begin in range(0, len(order), 16):
                grads = [np.zeros_like(x) for x in dense]
                bias_grad, touched, pulls = 0.0, [], []
                batch = order[begin : begin + 16]
                for doc in batch:
                    found = features[ids[doc]]
                    rows = table[found].sum(1) if len(found) else np.zeros((0, table.shape[1]), "f4")
                    pooled, places = [], []
                    for which, w in enumerate(sizes):
                        m = len(rows) - w + 1
                        if m < 1:
                            pooled.append(np.zeros(n, "f4"))
                            places.append(None)
                            continue
                        answer = sum(rows[k : k + m] @ self.filters[which][k] for k in range(w)) + self.biases[which]
                        at = answer.argmax(0)
                        pooled.append(np.maximum(answer[at, np.arange(n)], 0))
                        places.append(at)
                    hidden = np.concatenate(pooled)
                    drop = (random.random(len(hidden)) < 0.8) / 0.8
                    hidden = hidden * drop
                    p = 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.bias, -30, 30)))
                    error = float((p - labels[doc]) * weight[doc] / len(batch))
                    grads[-1] += error * hidden
                    bias_grad += error
                    back = error * self.out * drop * (hidden > 0)
                    for which, w in enumerate(sizes):
                        if places[which] is None:
                            continue
                        g = back[which * n : (which + 1) * n]
                        live = np.flatnonzero(g)
                        grads[len(sizes) + which][live] += g[live]
                        for k in range(w):
                            at = places[which][live] + k
                            grads[which][k][:, live] += rows[at].T * g[live]
                            touched.append(found[at].reshape(-1))
                            pulls.append(np.repeat(self.filters[which][k][:, live].T * g[live, None], most, axis=0))
                steps += 1
                now = rate / (1 + epoch)
                for x, g, a, b in zip(dense, grads, first, second):
                    g = g + decay * x
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    x -= now * 0.2 * (a / (1 - 0.9**steps)) / (np.sqrt(b / (1 - 0.999**steps)) + 1e-8)
                bias_square += bias_grad * bias_grad
                self.bias -= now * bias_grad / (bias_square**0.5 + 1e-8)
                if touched:
                    which, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                    total = np.zeros((len(which), table.shape[1]), "f4")
                    np.add.at(total, inverse, np.concatenate(pulls))
                    squares[which] += (total * total).mean(1)
                    table[which] -= now * total / (np.sqrt(squares[which])[:, None] + 1e-6)
                    table[-1] = 0
        self.embedding = table[:-1]
        return squares[:-1] > 0

    # Averaging. The filters, biases and outputs are one row of numbers.

    def dense(self) -> np.ndarray:
        return np.concatenate([x.ravel().astype("f8") for x in (*self.filters, *self.biases, self.out)] + [np.array([self.bias])])

    def set_dense(self, numbers: np.ndarray) -> None:
        at = 0
        for x in (*self.filters, *self.biases, self.out):
            x[...] = numbers[at : at + x.size].reshape(x.shape)
            at += x.size
        self.bias = float(numbers[at])


def _portions(texts: Iterable[str], size: int = 1_000_000) -> Iterator[list[str]]:
    some, held = [], 0
    for text in texts:
        some.append(text)
        held += len(text)
        if held > size:
            yield some
            some, held = [], 0
    if some:
        yield some


def may_learn(doc_id: Column) -> Column:
    """Documents whose labels may be used: those with crc32(doc_id as text) mod 5 <> 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


@dataclass
class ToxicityModel:
    """A fitted network and the thresholds by language; other languages use the one under None."""

    network: TextCnn
    thresholds: dict[str | None, float]

    def threshold(self, lang: str | None) -> float:
        return self.thresholds.get(lang if isinstance(lang, str) else None, self.thresholds[None])


# Calibration documents of each label that a language needs for a threshold of its own.
ENOUGH = 40


def set_aside(doc_id: Column) -> Column:
    """The fifth of the documents that calibrates."""

    @F.pandas_udf("boolean")
    def chosen(ids: pd.Series) -> pd.Series:
        return pd.Series([xxhash.xxh32_intdigest(str(i), 11) % 5 == 0 for i in ids.tolist()], dtype=bool)

    return chosen(doc_id)


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, text, lang, aside of every labelled document that may be learnt from, written out.

    Of rows that repeat an id the one with the smallest text counts.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & may_learn(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int").alias("toxic")).distinct()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"), lang.alias("lang"))
    one = likely_in(texts, usable, "doc_id").join(usable, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("x"))
    return stage(one.select("doc_id", "toxic", "x.*").withColumn("aside", set_aside(F.col("doc_id"))), "toxicity-labelled")


def _trained(sent, epochs: int, rate: float, ones: float):
    """The documents of each shard, which follow each other, fitted by a copy of the network; gives back what it became."""

    def fitted(shard: int, rows: Iterator[tuple[str, int]]) -> pd.DataFrame:
        network, labels = sent.value.copy(), []

        def texts() -> Iterator[list[str]]:
            for text, toxic in rows:
                labels.append(toxic)
                yield words_of(text)

        touched = np.flatnonzero(network.fit(texts(), labels, epochs, rate, ones=ones))
        out = [(-1, shard, b"", network.dense().tobytes())]
        for chunk in np.unique(touched // AVERAGED):
            at = touched[touched // AVERAGED == chunk]
            out.append((int(chunk), shard, at.astype("i4").tobytes(), network.embedding[at].astype("f8").tobytes()))
        return pd.DataFrame(out, columns=["chunk", "shard", "at", "numbers"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one_thread()
        rows = ((shard, text, toxic) for batch in batches for shard, text, toxic in zip(batch["shard"].tolist(), batch["text"], batch["toxic"].tolist()))
        for shard, group in groupby(rows, key=lambda row: row[0]):
            yield fitted(shard, (row[1:] for row in group))
        give_back()

    return run


def _averaged(dim: int):
    """The mean of a stretch of numbers over the shards that moved them, added in the order of the shards."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame, chunk = frame.sort_values("shard"), int(frame["chunk"].iloc[0])
        if chunk < 0:
            mean = np.mean([np.frombuffer(x) for x in frame["numbers"]], axis=0)
            return pd.DataFrame({"chunk": [chunk], "at": [b""], "numbers": [mean.tobytes()]})
        total, count = np.zeros((AVERAGED, dim)), np.zeros(AVERAGED, "i8")
        for at, numbers in zip(frame["at"], frame["numbers"]):
            rows = np.frombuffer(at, "i4") - chunk * AVERAGED
            total[rows] += np.frombuffer(numbers).reshape(-1, dim)
            count[rows] += 1
        rows = np.flatnonzero(count)
        return pd.DataFrame({"chunk": [chunk], "at": [(rows + chunk * AVERAGED).astype("i4").tobytes()], "numbers": [(total[rows] / count[rows, None]).tobytes()]})

    return run


def train(network: TextCnn, labelled: DataFrame, n: int, ones: float) -> None:
    """Fit on all ``n`` rows of text and toxic. The driver gets the averaged network of each round: of fixed size."""
    cells = 1 if n <= ALONE else math.ceil(n / CELL)
    rounds = min(ROUNDS, cells)
    shards = math.ceil(cells / rounds)
    # As many visits in all as ``ALONE`` documents get.
    epochs = min(EPOCHS, max(1, round(EPOCHS * ALONE / n))) if cells > 1 else EPOCHS
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(rounds * shards)).cast("int")
    dealt = labelled.select("doc_id", "toxic", "text", (cell / rounds).cast("int").alias("shard"), (cell % rounds).alias("round"))
    for turn in range(rounds):
        mine = dealt.where(F.col("round") == turn) if rounds > 1 else dealt
        mine = mine.repartition(2 * shards if shards > 1 else 1, "shard").sortWithinPartitions("shard", "doc_id", "toxic").select("shard", "text", "toxic")
        sent = labelled.sparkSession.sparkContext.broadcast(network)
        moved = mine.mapInPandas(_trained(sent, epochs, 0.02 / (1 + turn), ones), "chunk INT, shard INT, at BINARY, numbers BINARY")
        means = moved.groupBy("chunk").applyInPandas(_averaged(network.embedding.shape[1]), "chunk INT, at BINARY, numbers BINARY").collect()
        for row in means:
            if row.chunk < 0:
                network.set_dense(np.frombuffer(row.numbers))
            else:
                at = np.frombuffer(row.at, "i4")
                network.embedding[at] = np.frombuffer(row.numbers).reshape(len(at), -1)
        sent.unpersist()


def fit_model(docs: DataFrame, labels: DataFrame, clean_loss: float = CLEAN_LOSS) -> ToxicityModel:
    """Fits on four fifths of all labelled documents that may be learnt from, and calibrates on the rest.

    A language with ``ENOUGH`` calibration documents of each label has a threshold of its own; the others have that of
    all. Without labels of both kinds the score is 0 and nothing is rejected.
    """
    network = TextCnn.new()
    labelled = labelled_texts(docs, labels)
    found = {(r.aside, r.toxic): r["count"] for r in labelled.groupBy("aside", "toxic").count().collect()}
    if len({toxic for _, toxic in found}) < 2:
        network.out[:] = 0
        network.bias = -30.0
        return ToxicityModel(network, {None: 0.5})
    fitted = held = labelled
    if len(found) == 4:
        fitted, held = labelled.where("NOT aside"), labelled.where("aside")
        found = {k: n for k, n in found.items() if not k[0]}
    n = sum(found.values())
    train(network, fitted, n, sum(m for (_, toxic), m in found.items() if toxic) / n)
    return ToxicityModel(network, thresholds_of(network, held, clean_loss))


def thresholds_of(network: TextCnn, held: DataFrame, clean_loss: float) -> dict[str | None, float]:
    """A threshold for all, and one for each language with ``ENOUGH`` documents of each label in ``held``."""
    sent = held.sparkSession.sparkContext.broadcast(network)

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": batch["lang"], "toxic": batch["toxic"], "score": sent.value.scores(batch["text"])})

    scored = stage(map_frames(held.select("text", "lang", "toxic"), by_batch(run), "lang STRING, toxic INT, score DOUBLE"), "toxicity-held")
    clean, bad = F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)
    sizes = {None: tuple(scored.agg(clean, bad).first())}
    by_lang = scored.where("lang IS NOT NULL").groupBy("lang").agg(clean.alias("clean"), bad.alias("bad"))
    sizes |= {r.lang: (r.clean, r.bad) for r in by_lang.where(F.least("clean", "bad") >= ENOUGH).collect()}
    out = {}
    for lang, (n_clean, n_bad) in sizes.items():
        some = scored if lang is None else scored.where(F.col("lang") == lang)
        # The clean score at place int(clean_loss * n_clean), from 0, by falling score.
        place = (int(clean_loss * n_clean) + 0.5) / max(n_clean, 1)
        limit, low = some.agg(
            F.expr(f"percentile_disc({place:.17f}) WITHIN GROUP (ORDER BY IF(toxic = 0, score, NULL) DESC)"),
            F.percentile(F.when(F.col("toxic") == 1, F.col("score")), 0.05),
        ).first()
        out[lang] = calibrate(limit, low, n_clean)
    return out


def calibrate(limit: float, low: float, n_clean: int) -> float:
    """A threshold that keeps the clean documents and finds the toxic ones.

    It lies between ``limit``, the score that all but a share of the clean documents stay below, and ``low``, the score
    that all but a twentieth of the toxic ones pass: half-way, and nearer to the second the fewer clean documents there
    are. Where these cross, the clean documents decide, and it is 0.5 at least.
    """
    part = 0.5 + 0.5 / (1 + n_clean / 50)
    return float(max(0.25, limit + part * (low - limit)) if limit < low else max(0.5, np.nextafter(limit, 2)))


def _scored(sent):
    def rows(batch: pd.DataFrame) -> pd.DataFrame:
        model = sent.value
        scores = model.network.scores(batch["text"])
        thresholds = np.array([model.threshold(x) for x in batch["lang"]])
        return pd.DataFrame({"doc_id": batch["doc_id"], "score": scores, "threshold": thresholds})

    return by_batch(rows)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted (score of 0.5 or more), threshold of the language, rejected.

    A NULL or empty text scores what the network gives a text without words. A NULL id is never held out. Repeated
    rows each get a row; an empty table gives no rows. The language only chooses the threshold.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"), lang.alias("lang"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    found = map_frames(texts, _scored(sent), "doc_id BIGINT, score DOUBLE, threshold DOUBLE")
    return found.select(
        "doc_id",
        F.coalesce(~may_learn(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("rejected"),
    )


def _kept(sent):
    @F.pandas_udf("boolean")
    def below(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = sent.value
        for texts, langs in batches:
            scores = model.network.scores(texts)
            yield pd.Series(scores < np.array([model.threshold(x) for x in langs]))
        # Later stages run in the same worker and don't score.
        model.network.forget()
        give_back()

    return below


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents, with all their columns, whose score is below the threshold of their language.

    Python sees texts and languages only, so the other columns may be of any type.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.where(_kept(docs.sparkSession.sparkContext.broadcast(model))(whole(), lang))
