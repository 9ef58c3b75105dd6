"""Language identification with unigrams over a fixed public vocabulary, summed over segmentations.

A word's probability in a language is the sum, over all ways to cut it into pieces of the vocabulary,
of the product of the pieces' probabilities: the forward algorithm, run on many words at once. Piece
probabilities are fitted by expectation maximisation on word counts of a bounded sample of texts per
language. A text's evidence is the sum over all its words; words met before are looked up.

Words are lower-cased and begin with a mark, as pieces at word starts do. Bytes that no piece covers
have a small probability of their own, so every word has segmentations. The vocabulary is used whole,
whatever the length of its pieces. Words of over ``MOST`` bytes are cut only where no piece lies across the
cut, which changes no sum; what such cuts leave longer is summed place by place with its sums carried on.
One map over the texts, without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill.llm.labelled import within_bytes
from turnmill.llm.text import LOWER, mix, pieces, rolled, sums, words

MARK, MOST = 1, 48
_BASE = np.uint64(0xD1342543DE82EF95)
#: Bytes of ASCII letters, and those beyond ASCII.
LETTER, BEYOND = np.zeros(256, bool), np.arange(256) >= 128
LETTER[[*range(65, 91), *range(97, 123)]] = True
_BYTES = np.arange(1, 257, dtype=np.uint64)
#: Places in a worker's table of words.
TABLE = 1 << 20

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


class Vocabulary:
    """Pieces by the hash of their bytes; 256 more ids stand for single bytes."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = set()
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                found.add(model.id_to_piece(i).lower().replace("▁", chr(MARK)).encode())
        self.pieces = sorted(found)
        self.lengths = {len(p) for p in found}
        self.longest = max(self.lengths, default=1)
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        self.ids = np.argsort(hashes)
        self.hashes = hashes[self.ids]
        self.some = np.zeros(1 << 20, bool)
        self.some[hashes >> np.uint64(44)] = True
        self.size = len(self.pieces) + 256

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) & (1 << 64) - 1
        return int(mix(np.array([h], np.uint64))[0])

    def _known(self, rolling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some rolled hashes are pieces, and their ids."""
        hashed = mix(rolling)
        at = np.flatnonzero(self.some[hashed >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.hashes, hashed[at]), len(self.hashes) - 1)
        true = self.hashes[place] == hashed[at]
        return at[true], self.ids[place[true]]

    def matches(self, letters: np.ndarray) -> np.ndarray:
        """For strings as rows of bytes, 0 beyond their ends: the piece of each length at each place.

        The result's [w, i, k] is the id of the piece in letters[w, i:i + k + 1], or -1.
        """
        n, width = letters.shape
        out = np.full((n, width, min(self.longest, width)), -1, np.int32)
        rolling = np.zeros((n, width), np.uint64)
        value = letters.astype(np.uint64) + np.uint64(1)
        for k in range(out.shape[2]):
            upto = width - k
            rolling[:, :upto] = rolling[:, :upto] * _BASE + value[:, k:]
            if k + 1 in self.lengths:
                at = np.flatnonzero((letters[:, k:] > 0).ravel())
                true, ids = self._known(rolling[:, :upto].ravel()[at])
                at = at[true]
                out[at // upto, at % upto, k] = ids
        alone = (out[:, :, 0] < 0) & (letters > 0)
        out[:, :, 0][alone] = len(self.pieces) + letters[alone].astype(np.int32)
        return out

    def parts(self, body: bytes, block: int = 1 << 20) -> list[bytes]:
        """A string cut at every place that no piece lies across."""
        letters = np.frombuffer(body, np.uint8)
        cuts = [np.zeros(1, np.int64)]
        for a in range(0, len(letters), block):
            low = max(0, a - self.longest)
            value = letters[low : a + block + self.longest].astype(np.uint64) + np.uint64(1)
            across = np.zeros(len(value) + 1, np.int64)
            rolling = np.zeros(len(value), np.uint64)
            for k in range(min(self.longest, len(value))):
                upto = len(value) - k
                rolling[:upto] = rolling[:upto] * _BASE + value[k:]
                if k and k + 1 in self.lengths:
                    at, _ = self._known(rolling[:upto])
                    across[at + 1] += 1
                    across[at + k + 1] -= 1
            free = np.flatnonzero(np.cumsum(across) == 0) + low
            cuts.append(free[(free > max(a, 0)) & (free <= min(a + block, len(letters) - 1))])
        at = np.unique(np.concatenate(cuts)).tolist()
        return [body[x:y] for x, y in zip(at, [*at[1:], len(body)], strict=True)]


def as_rows(found: list[bytes]) -> np.ndarray:
    """Strings as rows of bytes."""
    rows = np.zeros((len(found), max(map(len, found), default=0)), np.uint8)
    for i, w in enumerate(found):
        rows[i, : len(w)] = np.frombuffer(w, np.uint8)
    return rows


def forward(matches: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Sums over the segmentations of each string's beginnings: [string, length, language]."""
    n, width, _ = matches.shape
    alpha = np.zeros((n, width + 1, chance.shape[1]))
    alpha[:, 0] = 1
    some = (matches >= 0).any(0)
    for i in range(width):
        for k in np.flatnonzero(some[i]).tolist():
            ids = matches[:, i, k]
            at = np.flatnonzero(ids >= 0)
            alpha[at, i + k + 1] += alpha[at, i] * chance[ids[at]]
    return alpha


def long_score(body: bytes, vocabulary: Vocabulary, chance: np.ndarray, block: int = 2048) -> np.ndarray:
    """Logarithm of a long string's sum in each language, place by place; sums are scaled as they shrink."""
    letters = np.frombuffer(body, np.uint8)
    longest, scale = vocabulary.longest, np.zeros(chance.shape[1])
    alpha = np.zeros((block + longest + 1, chance.shape[1]))
    alpha[0] = 1
    for a in range(0, len(letters), block):
        part = letters[a : a + block + longest]
        here = min(block, len(letters) - a)
        found = vocabulary.matches(part[None])[0]
        for i in range(here):
            if i % 16 == 0:
                top = np.maximum(alpha[i : i + longest + 1].max(0), 1e-300)
                alpha[i : i + longest + 1] /= top
                scale += np.log(top)
            ks = np.flatnonzero(found[i] >= 0)
            alpha[i + 1 + ks] += alpha[i] * chance[found[i, ks]]
        rest = alpha[here : here + longest + 1].copy()
        alpha[:] = 0
        alpha[: len(rest)] = rest
    return np.log(np.maximum(alpha[0], 1e-300)) + scale


def blocks(found: list[bytes], cells: int = 1 << 22) -> Iterator[list[int]]:
    """Places of strings of about one length, so many that their match tables stay small."""
    order = sorted(range(len(found)), key=lambda i: len(found[i]))
    a = 0
    while a < len(order):
        n = 1
        while a + n < len(order) and n < 4096 and (n + 1) * len(found[order[a + n]]) ** 2 <= cells:
            n += 1
        yield order[a : a + n]
        a += n


def word_scores(found: list[bytes], vocabulary: Vocabulary, chance: np.ndarray) -> np.ndarray:
    """Logarithm of each word's probability in each language."""
    out = np.zeros((len(found), chance.shape[1]))
    bodies, owner = [], []
    for i, word in enumerate(found):
        body = bytes([MARK]) + word
        for part in [body] if len(word) <= MOST else vocabulary.parts(body):
            if len(part) <= MOST + 1:
                bodies.append(part)
                owner.append(i)
            else:
                out[i] += long_score(part, vocabulary, chance)
    owner = np.array(owner, np.int64)
    for some in blocks(bodies):
        letters = as_rows([bodies[i] for i in some])
        alpha = forward(vocabulary.matches(letters), chance)
        length = (letters > 0).sum(1)
        np.add.at(out, owner[some], np.log(np.maximum(alpha[np.arange(len(some)), length], 1e-300)))
    return out.astype(np.float32)


def learn(counts: list[Counter], vocabulary: Vocabulary, rounds: int = 4, smooth: float = 0.05) -> np.ndarray:
    """Piece probabilities of each language from its words' counts: [piece, language].

    Words are cut like those to be scored; for the fit alone, parts of over ``MOST`` bytes are cut there.
    """
    split: list[Counter] = []
    for c in counts:
        bodies: Counter = Counter()
        for w, n in c.items():
            body = bytes([MARK]) + w
            for part in [body] if len(w) <= MOST else vocabulary.parts(body):
                for i in range(0, len(part), MOST + 1):
                    bodies[part[i : i + MOST + 1]] += n
        split.append(bodies)
    found = sorted(set().union(*split))
    often = np.array([[c[w] for c in split] for w in found], np.float64).reshape(len(found), len(split))
    base = np.full(vocabulary.size, 1.0 / vocabulary.size)
    base[len(vocabulary.pieces) :] = 1e-6
    chance = np.repeat(base[:, None], len(split), 1)
    for _ in range(rounds):
        expected = np.zeros_like(chance)
        for some in blocks(found):
            letters = as_rows([found[i] for i in some])
            matches = vocabulary.matches(letters)
            alpha = forward(matches, chance)
            n, width, _ = matches.shape
            length = (letters > 0).sum(1)
            whole = np.maximum(alpha[np.arange(n), length], 1e-300)
            beta = np.zeros_like(alpha)
            beta[np.arange(n), length] = 1
            weight = often[some] / whole
            any_ = (matches >= 0).any(0)
            for i in range(width - 1, -1, -1):
                for k in np.flatnonzero(any_[i]).tolist():
                    ids = matches[:, i, k]
                    at = np.flatnonzero(ids >= 0)
                    after = beta[at, i + k + 1] * chance[ids[at]]
                    beta[at, i] += after
                    np.add.at(expected, ids[at], alpha[at, i] * after * weight[at])
        pooled = (expected.sum(1) + 1) / (expected.sum() + len(expected))
        smoothed = expected + smooth * expected.sum(0) * pooled[:, None] + 1e-3
        chance = smoothed / smoothed.sum(0)
    return chance


class Scorer:
    """Language evidence of texts, with a table of words met before, the same size for any input."""

    def __init__(self, vocabulary: Vocabulary, chance: np.ndarray):
        self.vocabulary, self.chance = vocabulary, chance
        self.keys = np.zeros(TABLE, np.uint64)
        self.values = np.zeros((TABLE, chance.shape[1]), np.float32)

    def evidence(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each text in each language, and whether it has a letter."""
        w = words(column)
        starts, ends, first = w.starts, w.ends, w.first
        lower = LOWER[w.buf]
        key = rolled(lower, starts, ends, 0xD1342543DE82EF95, _BYTES) | np.uint64(1)
        slot = (key >> np.uint64(44)).astype(np.int64)
        fresh = np.flatnonzero(self.keys[slot] != key)
        values = self.values[slot]
        if len(fresh):
            new, at, back = np.unique(key[fresh], return_index=True, return_inverse=True)
            found = [lower[starts[i] : ends[i]].tobytes() for i in fresh[at]]
            scores = word_scores(found, self.vocabulary, self.chance)
            values[fresh] = scores[back]
            place = (new >> np.uint64(44)).astype(np.int64)
            self.keys[place], self.values[place] = new, scores
        # Places taken by two words of this piece hold the last; both wrote key and value alike.
        total = np.vstack([np.zeros((1, values.shape[1])), np.cumsum(values, 0, dtype=np.float64)])
        lettered = sums(LETTER[w.buf], w.offsets) > 0
        for i in np.flatnonzero(~lettered & (sums(BEYOND[w.buf], w.offsets) > 0)):
            lettered[i] = any(c.isalpha() for c in w.buf[w.offsets[i] : w.offsets[i + 1]].tobytes().decode())
        return total[first[1:]] - total[first[:-1]], lettered


_HELD: dict[str, Scorer] = {}


def sample_words(rows: list[tuple[str, str]]) -> tuple[list[str], list[Counter]]:
    """Languages in order, and the counts of lower-case words of each."""
    names = sorted({lang for lang, _ in rows})
    counts = {name: Counter() for name in names}
    for lang, text in rows:
        for w in text.encode().lower().split():
            counts[lang][w] += 1
    return names, [counts[name] for name in names]


def training_texts(docs: DataFrame, left_out: Column, per_lang: int, key: str, text: str, lang: str, most_bytes: int = 64 << 20) -> DataFrame:
    """Rows (lang, text): for each language the ``per_lang`` keys of least hash, one text of each.

    Ranks are limited in each of 64 parts of a language first, so a frequent language does not meet in
    one task; only the keys, at most ``per_lang`` for each language, are broadcast to the texts. Of several
    texts of a key in a language the one of least hash counts, and texts are left out once those of a language
    exceed ``most_bytes``.
    """
    usable = docs.filter(docs[lang].isNotNull() & docs[key].isNotNull() & ~left_out).select(docs[key].alias("at"), docs[lang].alias("as_lang"))
    ids = usable.distinct().withColumn("hash", F.xxhash64(F.col("at").cast("string"))).withColumn("part", F.pmod("hash", F.lit(64)))
    for keys in (["as_lang", "part"], ["as_lang"]):
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("hash", "at"))
        ids = ids.withColumn("nth", nth).filter(F.col("nth") <= per_lang)
    ids = ids.select("at", "as_lang")
    rows = docs.select(docs[key].alias("own"), docs[text].alias("text"), docs[lang].alias("own_lang")).filter("text IS NOT NULL")
    same = (rows["own"] == ids["at"]) & (rows["own_lang"] == ids["as_lang"])
    texts = rows.join(F.broadcast(ids), same).groupBy("at", F.col("as_lang").alias("lang"))
    one = texts.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return within_bytes(one, most_bytes, "lang").select("lang", "text")


def identify_languages(
    docs: DataFrame, vocabulary: str, left_out: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 400
) -> DataFrame:
    """The likeliest learned language of each document, and its share of the probability of all.

    ``vocabulary`` is the path of a sentencepiece model that every executor can read. ``left_out`` is
    a condition on the key that keeps rows out of the fit; at most ``per_lang`` texts per language, of 64 MB
    together, are fitted, on the driver. Texts that are null, empty or without letters are ``und`` with score 0,
    and so is everything if nothing was learned. Each row of ``docs`` gives one row.
    """
    sample = training_texts(docs, left_out, per_lang, key, text, lang).collect()
    names, counts = sample_words([(r["lang"], r["text"]) for r in sample])
    chance = learn(counts, Vocabulary(vocabulary)) if any(counts) else np.zeros((0, 0))
    model = f"{vocabulary}:{hash(chance.tobytes())}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _HELD and chance.size:
            _HELD.clear()
            _HELD[model] = Scorer(Vocabulary(vocabulary), chance)
        for batch in batches:
            for piece in pieces(batch):
                yield _predict(piece, _HELD.get(model), names)

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"), left_out.alias("held_out"))
    return rows.mapInArrow(run, SCHEMA)


def _predict(piece: pa.RecordBatch, scorer: Scorer | None, names: list[str]) -> pa.RecordBatch:
    score, said = np.zeros(piece.num_rows), np.full(piece.num_rows, "und", object)
    if scorer:
        evidence, lettered = scorer.evidence(piece.column(1))
        best = evidence.argmax(1)
        share = 1 / np.exp(np.maximum(evidence - evidence.max(1, keepdims=True), -700)).sum(1)
        score = np.where(lettered, share, 0.0)
        said[lettered] = np.array(names, object)[best[lettered]]
    return pa.RecordBatch.from_arrays(
        [piece.column(0), piece.column(2), pa.array(said.tolist(), pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"]
    )
