"""Toxicity of restored text: a noisy channel undoes disguised spelling before scoring.

Disguised tokens are decoded by Viterbi over a lattice of letters: look-alike digits and signs,
letters set apart by signs or spaces, letters repeated. A path costs what the channel charges
for its changes plus what a language model charges for its letters: trigrams counted over the
whole corpus, mixed with a lexicon of words. Letters set apart may hold several words, so there a
path may also end a word and begin another. The restored words then meet a logistic model, whose
features are words and word beginnings, counted and weighed against the length of the text.

A token may have any length: four or more equal characters in a row count as three, of more than
``BEAM`` states the cheapest go on, and every ``LAG`` characters the cheapest alone does, so that
time is linear in the length and memory bounded.

Learning: the weights come from at most about ``SAMPLE`` labelled rows of folds 1 to 4, taken by
a hash of doc_id. Letter trigrams and the lexicon come from every document; the lexicon has the
words that make up ``LEAST_SHARE`` of all words or more, which are at most one over that share.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.inputs import fold_of, in_slices, text_bytes, texts_of
from hazeline.plans.staging import stage

SAMPLE, FEATURES, MIN_DOCS, LEAST_Z, RIDGE = 16384, 384, 5, 5.0, 0.3
LEAST_SHARE, LEAST_COUNT, HELD_WORDS = 2e-6, 5, 200_000
BEGINNINGS, GATE, CLEAN_TAIL = (4, 5, 6, 7), 4, 1e-3
EDGE, OTHER, SYMBOLS = 0, 27, 28
LEXICON_SHARE, SIGN_COST, REPEAT_COST, MASK_COST, SKIP_COST, SPLIT_COST = 0.5, 1.0, 0.7, 3.0, 6.0, 2.0
BEAM, LAG, CACHED = 512, 2048, 64

# Letters that digits and signs stand for in disguised spelling.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "*": "aeiou",
}
SIGN = re.escape("".join(LOOKALIKES))
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CODES = np.array([b - 96 if 97 <= b <= 122 else OTHER if b >= 128 else EDGE for b in range(256)], np.int32)
SPACED = re.compile(rf"(?<!\S)(?:[a-z{SIGN}][ .\-_]){{3,}}[a-z{SIGN}](?![^\s.,;:?\"')])".encode())
SIGNS = re.compile(rf"[{SIGN}]+".encode())
TOKEN = re.compile(rf"[a-z{SIGN}\x80-\xff]+".encode())
LEET = re.compile(rf"(?=[^a-z]*[a-z])(?:[a-z]*[{SIGN}]+[a-z][a-z{SIGN}]*|[a-z]{{2,}}[{SIGN}])".encode())
SIGNED = bytes(35 if chr(c) in LOOKALIKES else p for c, p in enumerate(PLAIN))
LONG_RUN = re.compile(rf"([a-z{SIGN}])\1{{3,}}")
LEXICAL = re.compile(rb"(?!.*(.)\1\1)[a-z]{2,}")
TRIPLES = [bytes([c]) * 3 for c in range(97, 123)]
DRAWN = re.compile(rb"(?<![a-z\x80-\xff])[a-z]*([a-z])\1\1[a-z]*(?![a-z\x80-\xff])")


def disguised(low: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) of disguised tokens of a lower-case text, one kind after another."""
    yield from (m.span() for m in SPACED.finditer(low))
    done = 0
    for m in SIGNS.finditer(low):
        start = m.start()
        if start < done:
            continue
        while start > done and TOKEN.match(low, start - 1, start):
            start -= 1
        done = TOKEN.match(low, start).end()
        if LEET.fullmatch(low, start, done):
            yield start, done
    if any(triple in low for triple in TRIPLES):
        yield from (m.span() for m in DRAWN.finditer(low))


def letter_trigrams(docs: DataFrame) -> DataFrame:
    """(code, n): counts of letter trigrams over all texts, at most ``SYMBOLS`` cubed rows."""

    def per_batch(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in in_slices(batches):
            for text in batch["_text"].to_pylist():
                for at in range(0, len(text), 1 << 20):
                    letters = CODES[np.frombuffer((text[max(0, at - 2) : at + (1 << 20)] + b"  ").translate(LOWER), np.uint8)]
                    total += np.bincount((letters[:-2] * SYMBOLS + letters[1:-1]) * SYMBOLS + letters[2:], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["code", "n"])

    parts = docs.select(text_bytes().alias("_text")).mapInArrow(per_batch, "code int, n bigint")
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): words of two or more letters a to z over all texts. Words that touch a look-alike
    sign or draw out a letter are left out, as they may be disguised themselves."""

    def counted(words: Counter[bytes]) -> pa.RecordBatch:
        kept = [w for w in words if LEXICAL.fullmatch(w)]
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in kept], pa.string()), pa.array([words[w] for w in kept], pa.int64())], ["word", "n"]
        )

    def per_batch(batches):
        words: Counter[bytes] = Counter()
        for batch in in_slices(batches):
            for text in batch["_text"].to_pylist():
                words.update(text.translate(SIGNED).split())
                if len(words) > HELD_WORDS:
                    yield counted(words)
                    words.clear()
        yield counted(words)

    parts = docs.select(text_bytes().alias("_text")).mapInArrow(per_batch, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, least_share: float = LEAST_SHARE) -> dict[str, int]:
    """Counts of the words with a share of all words, at most ``1 / least_share`` of them."""
    counts = stage(word_counts(docs), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return dict(counts.where(F.col("n") >= max(LEAST_COUNT, least_share * total)).collect())


def _letters_of(back: tuple | None) -> str:
    """The letters of a path, which is its last letter and the path before."""
    letters = []
    while back:
        back, letter = back
        letters.append(letter)
    return "".join(reversed(letters))


@dataclass
class Channel:
    """Letter costs by trigram and word costs by lexicon, in nats."""

    letters: np.ndarray
    words: dict[str, float]

    def __post_init__(self):
        self.prefixes = {w[:i] for w in self.words for i in range(len(w) + 1)}
        self.cost = self.letters.tolist()
        self.cache: dict[bytes, str] = {}

    @classmethod
    def of(cls, counts: np.ndarray, words: dict[str, int]) -> Channel:
        table = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.5
        letters = -np.log(table / table.sum(axis=2, keepdims=True))
        total = sum(words.values()) or 1
        return cls(letters.reshape(-1), {w: -math.log(n / total) for w, n in words.items()})

    def options(self, token: str, at: int) -> list[tuple[str, float]]:
        """Letters that the character at this place may stand for, with costs; "" is a skip."""
        sign = token[at]
        if "a" <= sign <= "z":
            drawn = at > 0 and token[at - 1] == sign
            return [(sign, 0.0), ("", REPEAT_COST)] if drawn else [(sign, 0.0)]
        if sign not in LOOKALIKES:
            return [("", 0.0)]
        cost = MASK_COST if sign == "*" else SIGN_COST
        found = [(c, cost) for c in LOOKALIKES[sign]] + [("", SKIP_COST)]
        return found + [("", REPEAT_COST)] if at > 0 and token[at - 1] == sign else found

    def ended(self, state: tuple[int, int, str | None], value: tuple[float, float, tuple | None]) -> float:
        """The cost of a path that ends its word here: spelt by letters, or a word of the lexicon."""
        (a, b, prefix), (cost, spelled, _) = state, value
        by_letters = spelled - math.log(1 - LEXICON_SHARE) + self.cost[(a * SYMBOLS + b) * SYMBOLS]
        word = self.words.get(prefix, math.inf) - math.log(LEXICON_SHARE) if prefix else math.inf
        return cost - spelled + min(by_letters, word)

    def restore(self, token: str, spaced: bool = False) -> str:
        """The cheapest word behind a token, or words behind letters set apart.

        A state is the last two letters and the prefix of a lexicon word, or none; it has the cost
        of its path, the part of it that the trigrams charge for the word at hand, and the path.
        """
        states: dict[tuple[int, int, str | None], tuple[float, float, tuple | None]] = {(EDGE, EDGE, ""): (0.0, 0.0, None)}
        done: list[str] = []
        if not spaced:
            token = LONG_RUN.sub(r"\1\1\1", token)
        for at in range(len(token)):
            ahead: dict[tuple[int, int, str | None], tuple[float, float, tuple | None]] = {}
            options = self.options(token, at)
            for (a, b, prefix), (cost, spelled, back) in states.items():
                for letter, change in options:
                    if letter:
                        c = ord(letter) - 96
                        charge = self.cost[(a * SYMBOLS + b) * SYMBOLS + c]
                        longer = None if prefix is None or prefix + letter not in self.prefixes else prefix + letter
                        key, value = (b, c, longer), (cost + change + charge, spelled + charge, (back, letter))
                    else:
                        key, value = (a, b, prefix), (cost + change, spelled, back)
                    if key not in ahead or value[0] < ahead[key][0]:
                        ahead[key] = value
            if spaced and at + 1 < len(token) and options[0][0]:
                end, key = min(((self.ended(k, v), k) for k, v in ahead.items() if k[1] != EDGE), key=lambda e: e[0])
                start = (EDGE, EDGE, "")
                if start not in ahead or end + SPLIT_COST < ahead[start][0]:
                    ahead[start] = (end + SPLIT_COST, 0.0, (ahead[key][2], " "))
            if len(ahead) > BEAM:
                ahead = dict(nsmallest(BEAM, ahead.items(), key=lambda e: e[1][0]))
            if at % LAG == LAG - 1:
                key, (cost, spelled, back) = min(ahead.items(), key=lambda e: e[1][0])
                done.append(_letters_of(back))
                ahead = {key: (cost, spelled, None)}
            states = ahead
        best = min(states.items(), key=lambda e: self.ended(*e))
        return "".join([*done, _letters_of(best[1][2])])

    def spelling(self, text: str) -> float:
        """What the trigrams charge for a word, without its end."""
        a = b = EDGE
        total = 0.0
        for letter in text:
            c = ord(letter) - 96
            total += self.cost[(a * SYMBOLS + b) * SYMBOLS + c]
            a, b = b, c
        return total

    def found_in(self, text: bytes) -> list[tuple[int, int, str]]:
        """(start, end, word) of every disguised token of a text, in order of place."""
        low = text.translate(LOWER)
        found: list[tuple[int, int, str]] = []
        for start, end in sorted(set(disguised(low))):
            token = low[start:end]
            if found and start < found[-1][1]:
                continue
            word = self.cache.get(token)
            if word is None:
                word = self.restore(token.decode(), SPACED.fullmatch(token) is not None)
                if len(token) <= CACHED:
                    if len(self.cache) > 50_000:
                        self.cache.clear()
                    self.cache[token] = word
            found.append((start, end, word))
        return found

    def restorations(self, text: bytes) -> list[tuple[str, str]]:
        """(disguised, restored) of every disguised token of a text."""
        return [(text[i:j].translate(LOWER).decode(), word) for i, j, word in self.found_in(text)]

    def restored(self, text: bytes, found: list[tuple[int, int, str]]) -> bytes:
        """A text with the words behind its disguised tokens in their place."""
        parts, at = [], 0
        for start, end, word in found:
            parts += [text[at:start], word.encode()]
            at = end
        return b"".join([*parts, text[at:]]) if parts else text


def features(words: Counter[bytes]) -> Counter[bytes]:
    """Whole words, with a space at their end, and beginnings of words, with their counts."""
    found: Counter[bytes] = Counter()
    for word, n in words.items():
        found[word + b" "] += n
        for length in BEGINNINGS:
            if len(word) >= length:
                found[word[:length]] += n
    return found


def density(words: Counter[bytes]) -> float:
    """What a count is weighed by: 1 in a text of up to a hundred words, less in longer ones."""
    return (max(100, words.total()) / 100) ** -0.5


@dataclass
class ToxicityModel:
    channel: Channel
    weights: dict[bytes, float]
    bias: float

    def __post_init__(self):
        self.gate = {w[:GATE] for w in self.weights}

    def score(self, text: bytes, found: list[tuple[int, int, str]] | None = None) -> float:
        """The score of a text; ``found`` are its disguised tokens, if known."""
        found = self.channel.found_in(text) if found is None else found
        words = Counter(self.channel.restored(text, found).translate(PLAIN).split())
        near = Counter({w: n for w, n in words.items() if (w + b" ")[:GATE] in self.gate})
        total = sum(n * self.weights[f] for f, n in features(near).items() if f in self.weights)
        margin = self.bias + total * density(words)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, margin))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; the intercept is not shrunk."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)]).astype(np.float64)
    w, shrink = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + shrink
        w -= np.linalg.solve(hessian, x.T @ (p - y) + shrink @ w)
    return w[:-1], float(w[-1])


def headroom(margins: np.ndarray, y: np.ndarray) -> float:
    """Half the way between zero and the margin that all but ``CLEAN_TAIL`` of clean texts stay
    below, if that is negative. Labelled texts have several telling words; with it, one is enough
    where clean texts have none."""
    return max(0.0, -float(np.quantile(margins[y == 0], 1 - CLEAN_TAIL)) / 2)


def labelled_sample(labels: DataFrame, target: str, most: int = SAMPLE) -> DataFrame:
    """(doc_id, y) of at most about ``most`` labelled rows of folds 1 to 4, by a hash of doc_id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (fold_of(F.col("doc_id")) != 0))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(F.max(target).alias("y"))
    known = stage(known, "labelled")
    share = min(1.0, most / max(1, known.count()))
    return known.where((F.xxhash64("_id") / F.lit(2.0**64) + 0.5) <= share)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(y, text) of the sampled documents. The sample is broadcast; its size is bounded."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    joined = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    return joined.select(F.col("y").cast("bigint").alias("y"), "text")


def feature_counts(texts: DataFrame) -> DataFrame:
    """(feature, n, t): texts and toxic texts with each feature, of those in ``MIN_DOCS`` texts."""

    def per_batch(batches):
        for batch in batches:
            n, t = Counter(), Counter()
            for text, y in zip(batch["text"].to_pylist(), batch["y"].to_pylist()):
                found = features(Counter(text.translate(PLAIN).split())).keys()
                n.update(found)
                if y:
                    t.update(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array([t[f] for f in n], pa.int64())],
                ["feature", "n", "t"],
            )

    parts = texts.select("y", "text").mapInArrow(per_batch, "feature binary, n bigint, t bigint")
    return parts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where(F.col("n") >= MIN_DOCS)


def weighed(texts: DataFrame, chosen: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature values of the sampled texts, a row each, and their labels."""
    places = {f: i for i, f in enumerate(chosen)}

    def per_batch(batches):
        for batch in in_slices(batches):
            rows = np.zeros((batch.num_rows, len(places)), "<f4")
            for row, text in zip(rows, batch["text"].to_pylist()):
                words = Counter(text.translate(PLAIN).split())
                for feature, n in features(words).items():
                    if feature in places:
                        row[places[feature]] = n * density(words)
            yield pa.RecordBatch.from_arrays([batch["y"], pa.array([r.tobytes() for r in rows], pa.binary())], ["y", "x"])

    rows = texts.select("y", "text").mapInArrow(per_batch, "y bigint, x binary").collect()
    return np.array([np.frombuffer(r.x, "<f4") for r in rows]), np.array([r.y for r in rows], np.float64)


def _says_more(other, row) -> bool:
    """Whether a longer feature stands in the same texts as far as the counts tell."""
    return other.feature != row.feature and other.feature.startswith(row.feature) and (other.n, other.t) == (row.n, row.t)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> ToxicityModel:
    """Learn letter trigrams and the lexicon from all documents, weights from a bounded sample.

    Features count as telling from ``LEAST_Z`` standard deviations on. Without labels of both
    kinds, or telling features, every score is the share of toxic labels, or 0 without any.
    """
    counts = np.zeros(SYMBOLS**3)
    for code, n in letter_trigrams(docs).collect():
        counts[code] = n
    texts = stage(sampled_texts(docs, labelled_sample(labels, "toxic", most)), "texts")
    n, toxic = texts.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    frequent = stage(feature_counts(texts), "frequent")
    expected = F.col("n") * F.lit(toxic / max(1, n))
    ranked = frequent.withColumn("z", F.abs(F.col("t") - expected) / F.sqrt(expected + F.lit(1e-9)))
    telling = ranked.where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(FEATURES).collect()
    words = {r.feature[:-1].decode(): r.n for r in telling if LEXICAL.fullmatch(r.feature[:-1]) and r.feature.endswith(b" ")}
    channel = Channel.of(counts, words | lexicon(docs))
    if not telling or not 0 < toxic < n:
        share = toxic / n if n else 0.0
        return ToxicityModel(channel, {}, math.log((share + 1e-13) / (1 - share + 1e-13)))
    longest = [r for r in telling if not any(_says_more(o, r) for o in telling)]
    chosen = [bytes(r.feature) for r in longest]
    x, y = weighed(texts, chosen)
    weights, bias = logistic(x, y)
    bias += headroom(x @ weights + bias, y)
    return ToxicityModel(channel, dict(zip(chosen, weights.tolist())), bias)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted, restored) of every row.

    A null text counts as empty; its score is that of a text without any known word. Rows that
    repeat stay. ``restored`` lists the disguised tokens found with the words behind them.
    """
    small = ToxicityModel(Channel(model.channel.letters, model.channel.words), model.weights, model.bias)
    pair = pa.struct([("token", pa.string()), ("word", pa.string())])

    def per_batch(batches):
        for batch in in_slices(batches):
            scores, found = [], []
            for text in batch["_text"].to_pylist():
                tokens = small.channel.found_in(text)
                scores.append(small.score(text, tokens))
                found.append([{"token": text[i:j].decode(), "word": w} for i, j, w in tokens])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64()), pa.array(found, pa.list_(pair))],
                ["doc_id", "held_out", "score", "restored"],
            )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (fold_of(F.col("doc_id")) == 0).alias("held_out"), text_bytes().alias("_text"))
    scored = source.mapInArrow(
        per_batch, "doc_id bigint, held_out boolean, score double, restored array<struct<token: string, word: string>>"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with a score below one half, with all their columns."""
    model = fit(docs, labels)

    def per_batch(batches):
        for batch in in_slices(batches):
            yield batch.filter(pa.array([model.score(t) < 0.5 for t in texts_of(batch)], pa.bool_()))

    return docs.mapInArrow(per_batch, docs.schema)


def query(spark, folder: str) -> DataFrame:
    from hazeline.llm.inputs import table

    docs = table(spark, folder, "documents")
    model = fit(docs, table(spark, folder, "labels"))
    return score(docs, model).select("doc_id", "held_out", "score", "predicted")
