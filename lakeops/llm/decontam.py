"""Benchmark decontamination: latent semantic candidates, then longest common subsequences and answer checks.

What the latent space leaves out, by its rank or its limits, is found by the words that a passage must share with an item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lakeops.llm.words import NON_ALNUM, Hasher, grouped, mix, weighted
from lakeops.session import written_out

#: Words are hashed to this many features; passages have WINDOW words and begin every STRIDE words.
FEATURES, WINDOW, STRIDE = 1 << 17, 64, 32
#: Latent dimensions, further random directions, power iterations.
RANK, MORE, POWERS = 192, 32, 1
#: Benchmark passages that share one latent space, few enough for its rank to hold each of them; and spaces searched in
#: one scan of the documents, which bounds what a task holds.
SPACE_PASSAGES, SCAN_SPACES = 256, 8
#: Groups in which sums by feature are taken; a feature in this share of the documents is looked up for candidates only.
SUM_PARTS, FREQUENT = 64, 0.02
#: A passage is a latent candidate from this cosine and this share of the item's latent length on; others are ruled out by
#: the words they share with the item alone (see _Shared), so these two numbers lose no pair.
COSINE, SHARE = 0.5, 0.35
#: Listed words of documents that are looked at together.
SHARED_ROWS = 1 << 18
#: Leaked: so much of the item's words in order; or less, if so much of its rare words stands in order as well, and so much
#: of the answer's rare words anywhere in the document. Rare are words whose feature is not FREQUENT.
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.5
_SENTENCE = re.compile(r"[.!?:]\s+|\n")


def _hasher() -> Hasher:
    return Hasher(NON_ALNUM)


def _features(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(47)).astype(np.int64)


def _windows(words: int) -> np.ndarray:
    """First words of the passages of a text: every STRIDE words, until one reaches the end."""
    return np.arange(0, max(1, words - WINDOW + STRIDE), STRIDE) if words else np.zeros(0, np.int64)


def document_counts(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """Documents with words, and how many of them have each feature. A task gives one row for each feature at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, n, counts = _hasher(), 0, np.zeros(FEATURES, np.int64)
        for batch in batches:
            for _, group in grouped(batch.column(0).cast(pa.binary()).to_pylist()):
                number, _, _, hashes, _ = hasher.batch(group)
                once = np.unique(number * FEATURES + _features(hashes))
                counts += np.bincount(once % FEATURES, minlength=FEATURES)
                n += len(np.unique(once // FEATURES))
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, there]), pa.array(np.r_[n, counts[there]])], ["feature", "n"])

    out, total = np.zeros(FEATURES, np.int64), 0
    for feature, n in docs.select(text_col).mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect():
        if feature < 0:
            total = n
        else:
            out[feature] = n
    return total, out


def passages(items: DataFrame, id_col: str, text_col: str, idf: np.ndarray) -> DataFrame:
    """Passages of the benchmark: item, number, word hashes, answer hashes, and the TF-IDF row of length 1.

    The answer is the item's last sentence, or the last third of an item that is one sentence. Items without words have
    no passage.
    """
    fields = T.StructType([T.StructField("item", items.schema[id_col].dataType), *T.StructType.fromDDL("number long, part long, words binary, answer binary, feature array<long>, weight array<double>, length double").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = _hasher()
        for batch in batches:
            out = []
            for item, text in zip(batch.iloc[:, 0], batch.iloc[:, 1]):
                hashes = hasher.spans((text or "").encode())[2]
                sentences = [s for s in _SENTENCE.split(text or "") if len(hasher.spans(s.encode())[2])]
                answer = hasher.spans(sentences[-1].encode())[2] if len(sentences) > 1 else hashes[-max(1, len(hashes) // 3) :]
                for k, begin in enumerate(_windows(len(hashes))):
                    own = hashes[begin : begin + WINDOW]
                    feature, count = np.unique(_features(own), return_counts=True)
                    weight = count * idf[feature]
                    length = float(np.sqrt((weight**2).sum()))
                    number = mix(own ^ np.arange(1, len(own) + 1, dtype=np.uint64)).sum(dtype=np.uint64)
                    out.append((item, int(np.int64(number.view(np.int64))), k, own.tobytes(), answer.tobytes(), feature.tolist(), (weight / length).tolist(), length))
            if out:
                yield pd.DataFrame(out, columns=[f.name for f in fields])

    return items.select(id_col, text_col).mapInPandas(run, fields)


def latent_space(rows: DataFrame, count: int, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Features and their places in the latent space, by a randomised singular value decomposition of the rows.

    Rows (columns feature, weight) stay spread. A power step multiplies by the rows and back; what leaves the tasks is one
    vector for each feature, summed by feature, and square matrices of the rank. The driver ends up with the features that
    occur, at most FEATURES, times the rank.
    """
    wide = min(count, rank + MORE)

    def start(feature: np.ndarray) -> np.ndarray:
        cell = feature.astype(np.uint64)[:, None] * np.uint64(4096) + np.arange(1, wide + 1, dtype=np.uint64)
        return np.where(mix(cell) >> np.uint64(63), 1.0, -1.0)

    def summed(project) -> tuple[np.ndarray, np.ndarray]:
        """A^T (A X) by feature, where ``project`` gives the rows of X for features."""

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found: dict[int, np.ndarray] = {}
            for batch in batches:
                for feature, weight in zip(batch["feature"], batch["weight"]):
                    y = np.asarray(weight) @ project(np.asarray(feature))
                    for f, w in zip(feature, weight):
                        found[f] = found[f] + w * y if f in found else w * y
            if found:
                yield pd.DataFrame({"part": [f % SUM_PARTS for f in found], "feature": list(found), "vector": [v.tobytes() for v in found.values()]})

        def total(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("feature")
            feature = group["feature"].to_numpy()
            first = np.flatnonzero(np.r_[True, feature[1:] != feature[:-1]])
            sums = np.add.reduceat(np.stack([np.frombuffer(v) for v in group["vector"]]), first, axis=0)
            return pd.DataFrame({"part": group["part"].iloc[0], "feature": feature[first], "vector": [v.tobytes() for v in sums]})

        schema = "part long, feature long, vector binary"
        got = rows.select("feature", "weight").mapInPandas(partial, schema).groupBy("part").applyInPandas(total, schema).collect()
        got.sort(key=lambda r: r["feature"])
        return np.array([r["feature"] for r in got]), np.array([np.frombuffer(r["vector"]) for r in got]).reshape(len(got), wide)

    features, z = summed(start)
    for _ in range(POWERS + 1):
        basis = np.linalg.qr(z)[0]
        place = np.full(FEATURES, -1)
        place[features] = np.arange(len(features))
        features, z = summed(lambda f, basis=basis, place=place: basis[place[f]])
    # z = A^T A basis, so basis^T z holds the squared singular values of A within the basis.
    values, turn = np.linalg.eigh((basis.T @ z + z.T @ basis) / 2)
    best = np.argsort(values)[::-1][: min(rank, wide)]
    best = best[values[best] > 1e-9]
    return features, (basis @ turn[:, best]).astype(np.float32)


def common_words(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with one bit for each word of ``a``."""
    at: dict[int, int] = {}
    for k, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << k
    every = (1 << len(a)) - 1
    open_ = every
    for y in b:
        if m := at.get(y):
            u = open_ & m
            open_ = ((open_ + u) | (open_ - u)) & every
    return len(a) - open_.bit_count()


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: id, item, cosine, lcs and answer of the best passage.

    Words are runs of letters, digits and non-ASCII characters, in lower case. Passages of WINDOW words of every whole
    text are placed in the latent space of the benchmark's TF-IDF passages, with counts over all documents. Each one close
    to an item's passage in cosine, and holding enough of it, is compared word by word, with half a passage before and
    after it; so is every other one that shares enough words with an item's passage to be a pair at all, such as one of
    many short items listed together, which is close to none of them. So the pairs are those of comparing every passage
    with every item. ``lcs`` is the share of the item's words found in order, ``rare`` that of its rare words, and ``answer`` the
    share of its answer's rare words found anywhere in the document, each by its weight. A pair is kept with lcs from
    VERBATIM on, or with lcs and rare from PARAPHRASE on and answer from ANSWER on: words that many documents share don't
    make a paraphrase, so an item without rare words leaks only word for word. For an answer without any, rare stands in.

    Null or empty texts and items have no words and no pairs. Rows of one id give the pairs of all of them, each once.
    Rows with a null id give pairs with a null id. Empty tables give an empty table. Other columns are not looked at.
    """
    docs = docs.select(F.col(id_col), F.lower(F.col(text_col)).alias(text_col))
    items = items.select(F.col(item_col), F.lower(F.col(item_text_col)).alias(item_text_col))
    n, counts = document_counts(docs, text_col)
    idf = np.log1p(max(n, 1) / np.maximum(counts, 1))
    every = written_out(passages(items, item_col, item_text_col, idf))
    total = every.count()
    spaces = max(1, -(-total // (SPACE_PASSAGES * 3 // 4)))
    place = F.pmod(F.xxhash64("number", "part"), F.lit(spaces))
    out = None
    for k in range(0, spaces, SCAN_SPACES):
        scan = _search(docs, [every.where(place == x) for x in range(k, min(k + SCAN_SPACES, spaces))], idf, id_col, text_col, item_col)
        out = scan if out is None else out.union(scan)
    best = out.groupBy(id_col, item_col).agg(F.max(F.struct("lcs", "rare", "answer", "cosine")).alias("best"))
    return best.select(id_col, item_col, "best.cosine", "best.lcs", "best.rare", "best.answer")


def _pieces(window: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Ranges of about ``most`` places that part no window; ``window`` is sorted."""
    a = 0
    while a < len(window):
        b = min(len(window), a + most)
        b = int(np.searchsorted(window, window[b - 1], side="right"))
        yield a, b
        a = b


class _Windows:
    """The windows of some texts, numbered through, given each text's first and last word."""

    def __init__(self, number: np.ndarray, cut: np.ndarray) -> None:
        self.number, self.cut = number, cut
        length = np.diff(cut)
        # As many as _windows gives.
        self.count = np.where(length > 0, np.maximum(1, -(-(length - WINDOW + STRIDE) // STRIDE)), 0)
        self.first = np.cumsum(self.count) - self.count

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every window that each of the words stands in, and the word, by window."""
        text = self.number[at]
        last = (at - self.cut[text]) // STRIDE
        windows, words = [], []
        for back in range(WINDOW // STRIDE):
            k = last - back
            there = (k >= 0) & (k < self.count[text])
            windows.append((self.first[text] + k)[there])
            words.append(at[there])
        window, word = np.concatenate(windows), np.concatenate(words)
        order = np.argsort(window, kind="stable")
        return window[order], word[order]

    def begin(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and first word of windows."""
        text = np.searchsorted(self.first + self.count, window, side="right")
        return text, self.cut[text] + (window - self.first[text]) * STRIDE

    def words(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows again, once for each of their words, and the words."""
        text, begin = self.begin(window)
        n = np.minimum(begin + WINDOW, self.cut[text + 1]) - begin
        return np.repeat(window, n), np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)


class _Space:
    """A latent space and the benchmark passages placed in it."""

    def __init__(self, block: DataFrame, idf: np.ndarray) -> None:
        kept = block.collect()
        features, self.vectors = latent_space(block, len(kept)) if kept else (np.zeros(0, np.int64), np.zeros((0, 1), np.float32))
        self.place = np.full(FEATURES, -1, np.int32)
        self.place[features] = np.arange(len(features))
        self.items = [r["item"] for r in kept]
        self.words = [np.frombuffer(r["words"], np.uint64).tolist() for r in kept]
        seldom = idf >= np.log1p(1 / FREQUENT)
        self.seldom = seldom
        self.rare_words = [[w for w in own if seldom[w >> 47]] for own in self.words]
        answers = [np.unique(np.frombuffer(r["answer"], np.uint64)) for r in kept]
        self.answers = [a[seldom[_features(a)]] for a in answers]
        self.answer_weights = [idf[_features(a)] for a in self.answers]
        queries = np.zeros((len(kept), self.vectors.shape[1]), np.float32)
        for k, r in enumerate(kept):
            queries[k] = np.asarray(r["weight"], np.float32) @ self.vectors[self.place[r["feature"]]]
        norm = np.linalg.norm(queries, axis=1)
        unit = queries / np.maximum(norm, 1e-12)[:, None]
        # In the documents a passage isn't scaled to length 1, so an item's latent length is in units of its own length.
        self.latent_length = norm * np.array([r["length"] for r in kept], np.float32)
        self.vectors = self.vectors * idf[features][:, None].astype(np.float32)
        # What one word adds to the product of a window with each item. Frequent words add little: with the most that a
        # window of them can add, rare words alone tell which windows can reach an item at all.
        self.added = self.vectors @ unit.T
        frequent = idf[features] < np.log1p(1 / FREQUENT)
        most = WINDOW * np.maximum(self.added[frequent].max(axis=0, initial=0), 0)
        self.least = SHARE * self.latent_length - most
        if (self.least <= 0).any():
            self.least, frequent = SHARE * self.latent_length, np.zeros(len(features), bool)
        self.most = self.added.max(axis=1, initial=0)
        self.rare = np.zeros(FEATURES, bool)
        self.rare[features[~frequent]] = True

    def near(self, place: _Windows, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, passage and cosine of the candidates among the windows of some texts, given each word's feature."""

        def sums(window: np.ndarray, feature: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            first = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
            return window[first], np.add.reduceat(each[self.place[feature]], first, axis=0)

        def products(window: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """As sums of ``added`` but for rounding: the longest windows first, one word of each at a time."""
            first = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
            words, row = np.diff(np.r_[first, len(window)]), self.place[feature]
            by_words = np.argsort(-words, kind="stable")
            first = first[by_words]
            total = self.added[row[first]]
            for k, n in enumerate(np.cumsum(np.bincount(words)[::-1])[::-1][2:], 1):
                total[:n] += self.added[row[first[:n] + k]]
            return window[first], total

        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        window, at = place.of(np.flatnonzero(self.rare[feature]))
        if not len(window):
            return none
        # One number for each word, the most it adds to any item, rules out most windows before items are looked at.
        first = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        enough = np.add.reduceat(self.most[self.place[feature[at]]], first) >= self.least.min() * (1 - 1e-4)
        kept = np.repeat(enough, np.diff(np.r_[first, len(window)]))
        window, at = window[kept], at[kept]
        likely = [none[0]]
        for a, b in _pieces(window):
            owner, product = products(window[a:b], feature[at[a:b]])
            likely.append(np.sort(owner[(product >= self.least * (1 - 1e-4)).any(axis=1)]))
        window, at = place.words(np.concatenate(likely))
        known = self.place[feature[at]] >= 0
        window, at = window[known], at[known]
        found = [none]
        for a, b in _pieces(window):
            owner, product = sums(window[a:b], feature[at[a:b]], self.added)
            size = np.linalg.norm(sums(window[a:b], feature[at[a:b]], self.vectors)[1], axis=1)
            close = (product >= COSINE * size[:, None]) & (product >= SHARE * self.latent_length[None, :]) & (product > 0)
            x, item = np.nonzero(close)
            found.append((owner[x], item, np.minimum(1.0, product[x, item] / size[x]).astype(float)))
        return tuple(np.concatenate(c) for c in zip(*found))

    def cosine(self, feature: np.ndarray, item: int) -> float:
        """Latent cosine of a passage, given its features, and an item's passage."""
        at = self.place[feature]
        at = at[at >= 0]
        size = float(np.linalg.norm(self.vectors[at].sum(axis=0)))
        return min(1.0, float(self.added[at, item].sum()) / size) if size else 0.0

    def checked(self, hashes: np.ndarray, begin: int, item: int) -> tuple[float, float, float]:
        """lcs, rare and answer (see :func:`leaks`) of a passage and a document's words around ``begin``."""
        near = hashes[max(0, begin - STRIDE) : begin + WINDOW + STRIDE]
        lcs = common_words(self.words[item], near.tolist()) / len(self.words[item])
        rare, answer = self.rare_words[item], self.answers[item]
        if lcs < PARAPHRASE or not rare:
            return lcs, 0.0, 0.0
        in_order = common_words(rare, near[self.seldom[_features(near)]].tolist()) / len(rare)
        weight = self.answer_weights[item]
        return lcs, in_order, float(weight[np.isin(answer, hashes)].sum() / weight.sum()) if len(answer) else in_order


def _least(share: float, words: int) -> int:
    """The fewest of some words that are such a share of them."""
    return next(n for n in range(words + 1) if n >= share * words or n / max(words, 1) >= share)


class _Shared:
    """The passages of some spaces by their words: windows that share enough of them to be a pair, whatever their cosine.

    A pair by VERBATIM shares so much of the item's words, hence all of its rare words but so many; one by PARAPHRASE so
    much of both. Texts are ruled out by the rare words they hold anywhere, then windows by all words around them, each
    word counted no more often than the item has it. An item with too few rare words to count on is known by all words.
    """

    def __init__(self, spaces: list[_Space]) -> None:
        listed, self.of, self.words, self.least, least = [], [], [], [], []
        for s, space in enumerate(spaces):
            for k, own in enumerate(space.words):
                rare = np.array(space.rare_words[k], np.uint64)
                verbatim, some = _least(VERBATIM, len(own)), _least(PARAPHRASE, len(rare))
                few = len(rare) - (len(own) - verbatim)
                first = [(rare, min(few, some))] if few > 0 else [(np.array(own, np.uint64), verbatim), *([(rare, some)] if len(rare) else [])]
                word, times = np.unique(np.array(own, np.uint64), return_counts=True)
                for held, n in first:
                    listed.append(np.unique(held, return_counts=True))
                    least.append(n)
                    self.of.append(len(self.words))
                self.words.append((s, k, word, times, np.isin(word, rare)))
                self.least.append((verbatim, _least(PARAPHRASE, len(own)), some if len(rare) else len(own) + 1))
        entry = np.repeat(np.arange(len(listed)), np.array([len(w) for w, _ in listed], np.int64))
        words = np.concatenate([np.zeros(0, np.uint64), *[w for w, _ in listed]])
        order = np.argsort(words, kind="stable")
        self.word, self.first, self.count = np.unique(words[order], return_index=True, return_counts=True)
        self.entry, self.times = entry[order], np.concatenate([np.zeros(0, np.int64), *[t for _, t in listed]])[order]
        self.of, self.enough = np.array(self.of, np.int64), np.array(least, np.int64)
        self.feature = np.zeros(FEATURES, bool)
        self.feature[_features(self.word)] = True

    def _texts(self, number: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text and passage where the text holds enough of the passage's listed words; ``number`` and ``word`` by text, once each."""
        end = np.cumsum(self.count[word])
        a = 0
        while a < len(number):
            b = int(np.searchsorted(end, (end[a - 1] if a else 0) + SHARED_ROWS, side="right"))
            b = int(np.searchsorted(number, number[max(a, min(b, len(number)) - 1)], side="right"))
            n = self.count[word[a:b]]
            row = np.arange(n.sum()) + np.repeat(self.first[word[a:b]] - (np.cumsum(n) - n), n)
            key = np.repeat(number[a:b], n) * len(self.enough) + self.entry[row]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            text, entry = np.divmod(key[first], len(self.enough))
            kept = np.add.reduceat(self.times[row][order], first) >= self.enough[entry]
            found = np.unique(text[kept] * len(self.words) + self.of[entry[kept]])
            yield np.divmod(found, len(self.words))
            a = b

    def near(self, place: _Windows, hashes: np.ndarray, feature: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Text, first word in it, space and passage of each window that shares enough with a passage."""
        at = np.flatnonzero(self.feature[feature])
        word = np.searchsorted(self.word, hashes[at])
        there = word < len(self.word)
        there[there] = self.word[word[there]] == hashes[at[there]]
        once = np.unique(place.number[at[there]] * max(1, len(self.word)) + word[there])
        for texts, passages_ in self._texts(*np.divmod(once, max(1, len(self.word)))):
            for text, passage in zip(texts.tolist(), passages_.tolist()):
                s, k, words, times, rare = self.words[passage]
                own = hashes[place.cut[text] : place.cut[text + 1]]
                word = np.searchsorted(words, own).clip(0, len(words) - 1)
                held = np.flatnonzero(words[word] == own)
                window = np.stack([held // STRIDE + n for n in range(1, 1 - (WINDOW + 2 * STRIDE) // STRIDE, -1)], 1)
                key, n = np.unique(window * len(words) + word[held][:, None], return_counts=True)
                window, word = np.divmod(key, len(words))
                n, low = np.minimum(n, times[word]), window.min(initial=0)
                every, few = np.bincount(window - low, n), np.bincount(window - low, n * rare[word])
                verbatim, most, some = self.least[passage]
                for w in (np.flatnonzero((every >= verbatim) | ((every >= most) & (few >= some))) + low).tolist():
                    if 0 <= w < place.count[text]:
                        yield text, w * STRIDE, s, k


def _search(docs: DataFrame, blocks: list[DataFrame], idf: np.ndarray, id_col: str, text_col: str, item_col: str) -> DataFrame:
    spaces = [_Space(block, idf) for block in blocks]
    shared = _Shared(spaces)
    item_type = blocks[0].schema["item"].dataType
    item_arrow = to_arrow_type(item_type)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(item_col, item_type), *T.StructType.fromDDL("cosine double, lcs double, rare double, answer double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in batches:
            rows, out = [], []
            for first, group in grouped(batch.column(1).cast(pa.binary()).to_pylist()):
                number, _, _, hashes, _ = hasher.batch(group)
                feature = _features(hashes)
                cut = np.searchsorted(number, np.arange(len(group) + 1))
                place = _Windows(number, cut)
                likely = {}
                for s, space in enumerate(spaces):
                    window, item, cosine = space.near(place, feature)
                    text, begin = place.begin(window)
                    likely.update(zip(zip(text.tolist(), (begin - cut[text]).tolist(), [s] * len(text), item.tolist()), cosine.tolist()))
                for key in shared.near(place, hashes, feature):
                    likely.setdefault(key)
                for (doc, begin, s, k), near in likely.items():
                    space, own = spaces[s], hashes[cut[doc] : cut[doc + 1]]
                    lcs, rare, answer = space.checked(own, begin, k)
                    if lcs >= VERBATIM or (lcs >= PARAPHRASE and rare >= PARAPHRASE and answer >= ANSWER):
                        rows.append(first + doc)
                        out.append((space.items[k], space.cosine(_features(own[begin : begin + WINDOW]), k) if near is None else near, lcs, rare, answer))
            columns = list(zip(*out)) if out else [()] * 5
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(columns[0], item_arrow), *[pa.array(c, pa.float64()) for c in columns[1:]]], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def without_leaks(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the ids in ``found``, the result of leaks. Rows without an id stay."""
    ids = written_out(found.where(F.col(id_col).isNotNull()).select(id_col).distinct())
    return docs.join(ids.hint("merge"), id_col, "left_anti").select(*docs.columns)
