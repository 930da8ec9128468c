"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary; each language has a probability for every piece. A word's
probability is the sum over all ways to cut it into pieces, found by a forward pass; a text's is the product over its
words; the language with the greatest wins, and the score is its posterior under equal priors. Probabilities are fitted by
expectation-maximisation: the forward and backward passes give the expected count of each piece in each word, which
are summed over the words of a language.

The fit takes a bounded sample of labelled rows, ``max_docs`` of each language in expectation. Spark counts the
sample's words and, in each round, sums the expected counts; the driver holds pieces by languages only.

Words are the runs of letters and combining marks in white-space words, in lower case, the first of each with the
vocabulary's word mark before it. Every piece of the vocabulary that such a run can hold takes part, and a run is scored
whole, whatever its length: the forward pass keeps the prefixes that a piece can reach back to, rescales them as it goes,
and builds the lattice by stretches. Only the fit cuts runs, at ``FIT_LETTERS`` letters. Null texts and texts without a letter are
``und`` with score 0, as is every text when nothing was learned. Null languages are not learned. Repeated rows each get
their result; in ``predict``, other columns pass through unless they bear the names of its results, which replace them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

MARK = "▁"
MAX_DOCS = 3000  # of each language
ROUNDS = 3
FIT_LETTERS = 4096
FLOOR = 1e-7  # of a character that no piece covers, and of pieces not seen in a language
CACHE = 300_000
STRETCH = 4096  # letters of a run whose pieces are listed at once
CELLS = 1 << 18  # words by letters that the fit takes at once
SCORED_CELLS = CELLS // 4  # and that predict does: a word's score is its own, so fewer only save memory
SCORED_BYTES = 2 << 20  # of texts that predict takes at once, for the same reason
RESCALE = 8  # letters; fewer than a double's range holds of the least probabilities
_RUN = regex.compile(r"[\p{L}\p{M}]+")


class Trie:
    """The pieces as transitions from prefix to prefix: a sorted array of (prefix, character), looked up by binary search."""

    def __init__(self, pieces: dict[str, int]):
        number, rows, steps = {"": 0}, [-1], {}
        for piece, row in pieces.items():
            for k in range(1, len(piece) + 1):
                if piece[:k] not in number:
                    number[piece[:k]] = len(rows)
                    steps[number[piece[: k - 1]] << 21 | ord(piece[k - 1])] = len(rows)
                    rows.append(-1)
            rows[number[piece]] = row
        keys = sorted(steps)
        self.keys = np.array([*keys, 1 << 62], np.int64)
        self.to = np.array([*(steps[k] for k in keys), 0], np.int64)
        self.row = np.array(rows, np.int64)
        self.longest = max(map(len, pieces), default=1)

    def step(self, state: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the prefixes go on with their character, and the prefixes that those lead to."""
        key = state << 21 | char
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return hit, self.to[at[hit]]


def _rows(path: str) -> dict[str, int]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        body = piece.removeprefix(MARK)
        if _RUN.fullmatch(body) and body == body.lower():
            rows.setdefault(piece, len(rows) + 1)
    return rows


def vocabulary(path: str) -> Trie:
    """Lower-case pieces of letters and marks, with the word mark, to rows; characters outside it share row 0."""
    return tx.warm(("langid pieces", path), lambda: Trie(_rows(path)))


class Known:
    """Scores of words already seen: the rows of one array, by word."""

    def __init__(self, languages: int):
        self.rows: dict[str, int] = {}
        self.logs = np.zeros((0, languages))

    def score(self, runs: set[str], pieces: Trie, p: np.ndarray) -> None:
        """Scores those runs that are new."""
        if len(self.rows) > CACHE:
            self.__init__(p.shape[1])
        new = sorted((x for x in runs if x not in self.rows), key=len)  # words of a length share an array
        scored = [Lattice(new[lo:hi], pieces).log_probability(p) for lo, hi in groups(new, SCORED_CELLS)]
        self.rows.update(zip(new, range(len(self.logs), len(self.logs) + len(new)), strict=True))
        self.logs = np.concatenate([self.logs, *scored])

    def total(self, split: list[list[str]]) -> np.ndarray:
        """(words, languages): the sums over the runs of each word."""
        out = np.zeros((len(split), self.logs.shape[1]))
        for k in range(max(map(len, split), default=0)):
            at = [i for i, s in enumerate(split) if len(s) > k]
            out[at] += self.logs[[self.rows[split[i][k]] for i in at]]
        return out


def remembered(key: str, languages: int) -> Known:
    """Scores of words already seen by this worker under one model."""
    return tx.warm(("langid", key), lambda: Known(languages))


def parts(word: str) -> list[str]:
    """The runs of letters and marks that a white-space word is scored by, the first with the word mark."""
    low = word.lower()
    runs = [low] if low.isalpha() else _RUN.findall(low)
    if runs:
        runs[0] = MARK + runs[0]
    return runs


def groups(words: list[str], cells: int = CELLS) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of words, sorted by length, of at most ``cells`` letters if the longest, or 16, counts for all."""
    lo = 0
    for hi in range(1, len(words) + 1):
        if hi == len(words) or (hi + 1 - lo) * max(16, len(words[hi])) > cells:
            yield lo, hi
            lo = hi


class Lattice:
    """All pieces in all words."""

    def __init__(self, words: list[str], pieces: Trie | dict[str, int]):
        self.trie = pieces if isinstance(pieces, Trie) else Trie(pieces)
        self.n = len(words)
        self.lens = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(self.lens) - self.lens
        self.chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        self.width = int(self.lens.max()) if self.n else 0

    def edges(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word, begin, end and row of the pieces that end in (lo, hi]; a character always can stand alone."""
        a = np.minimum(self.lens, max(0, lo + 1 - self.trie.longest))
        stop = np.minimum(self.lens, hi)
        n = stop - a
        of = np.repeat(np.arange(self.n), n)
        begin = np.arange(len(of)) - np.repeat(np.cumsum(n) - n - a, n)
        at, room = self.first[of] + begin, stop[of] - begin
        live, state, found = np.arange(len(of)), np.zeros(len(of), np.int64), []
        for k in range(self.trie.longest):
            fits = room[live] > k
            live, state = live[fits], state[fits]
            hit, to = self.trie.step(state, self.chars[at[live] + k])
            if k == 0:
                row = np.zeros(len(live), np.int64)
                row[hit] = np.maximum(self.trie.row[to], 0)
                found.append((live, np.ones(len(live), np.int64), row))
            live, state = live[hit], to
            if k:
                row = self.trie.row[state]
                piece = row >= 0
                found.append((live[piece], np.full(int(piece.sum()), k + 1), row[piece]))
        live, length, row = (np.concatenate(x) for x in zip(*found, strict=True))
        of, begin = of[live], begin[live]
        end = begin + length
        late = end > lo
        order = np.argsort(end[late] * self.n + of[late], kind="stable")
        return tuple(x[late][order] for x in (of, begin, end, row))

    def _sweep(self, p: np.ndarray, stretches: Iterator[tuple], logs: np.ndarray | None = None) -> np.ndarray:
        """(words, languages): log of the sum over all segmentations; ``logs`` takes those of all prefixes."""
        ring = self.trie.longest + 1
        alpha = np.zeros((self.n, ring, p.shape[1]))
        alpha[:, 0] = 1.0
        shift, out = np.zeros((self.n, p.shape[1])), np.zeros((self.n, p.shape[1]))
        for of, begin, end, row in stretches:
            if not len(of):
                continue
            heads = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (end[1:] != end[:-1])]))
            ends = np.arange(end[0], end[-1] + 2)
            stops, head_stops = np.searchsorted(end, ends), np.searchsorted(end[heads], ends)
            slot, weight = begin % ring, p[row]
            for k, j in enumerate(ends[:-1].tolist()):
                s, e = stops[k], stops[k + 1]
                head = heads[head_stops[k] : head_stops[k + 1]]
                words = of[head]
                now = np.add.reduceat(alpha[of[s:e], slot[s:e]] * weight[s:e], head - s, axis=0)
                alpha[words, j % ring] = now
                last = self.lens[words] == j
                if logs is not None:
                    logs[words, j] = np.log(now) + shift[words]
                out[words[last]] = np.log(now[last]) + shift[words[last]]
                if j % RESCALE == 0:
                    alpha[words] /= now[:, None]
                    shift[words] += np.log(now)
        return out

    def log_probability(self, p: np.ndarray) -> np.ndarray:
        """(words, languages): log of the sum over all segmentations."""
        return self._sweep(p, (self.edges(lo, lo + STRETCH) for lo in range(0, self.width, STRETCH)))

    def expected(self, p: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected occurrences of every piece, for words that occur ``count`` times in each language."""
        of, begin, end, row = self.edges(0, self.width)
        prefix, suffix = (np.zeros((self.n, self.width + 1, p.shape[1])) for _ in range(2))
        whole = self._sweep(p, [(of, begin, end, row)], prefix)
        left = self.lens[of] - begin  # the words from their ends: a piece begins where it ended
        order = np.argsort(left * self.n + of, kind="stable")
        self._sweep(p, [tuple(x[order] for x in (of, self.lens[of] - end, left, row))], suffix)
        share = np.exp(prefix[of, begin] + np.log(p[row]) + suffix[of, self.lens[of] - end] - whole[of]) * count[of]
        return np.stack([np.bincount(row, weights=share[:, k], minlength=len(p)) for k in range(p.shape[1])], axis=1)


class Model:
    def __init__(self, path: str, languages: list[str], p: np.ndarray):
        self.path, self.languages, self.p = path, languages, p


def _word_counts(docs: DataFrame) -> DataFrame:
    """lang, part, n over all rows of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in tx.slices(batches):
            lang = rows.column("lang").dictionary_encode()
            starts, ends, bounds = tx.words(data, off)
            codes, distinct = tx.codes(data, starts, ends)
            of = lang.indices.to_numpy().astype(np.int64)[tx.by_doc(bounds)]
            key, n = np.unique(of * max(1, len(distinct)) + codes, return_counts=True)
            out: dict[tuple[str, str], int] = {}
            names = lang.dictionary.to_pylist()
            split = [[r[i : i + FIT_LETTERS] for r in parts(w) for i in range(0, len(r), FIT_LETTERS)] for w in distinct]
            for k, c in zip(key.tolist(), n.tolist(), strict=True):
                for part in split[k % len(distinct)]:
                    at = (names[k // len(distinct)], part)
                    out[at] = out.get(at, 0) + c
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.string()), pa.array(list(out.values()), pa.int64())], ["lang", "part", "n"])

    return docs.mapInArrow(run, "lang string, part string, n long").groupBy("lang", "part").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, path: str, max_docs: int = MAX_DOCS, rounds: int = ROUNDS) -> Model:
    """Learns piece probabilities from rows with a language and a text."""
    spark = docs.sparkSession
    tx.small_batches(spark)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    size = len(_rows(path)) + 1
    if not languages:
        return Model(path, [], np.zeros((size, 0)))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, max_docs / n)).otherwise(share)
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")
    words = _word_counts(sample).groupBy("part").agg(*[F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, lang in enumerate(languages)])
    words = words.checkpoint()  # read once for each round
    p = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(p)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, pieces = sent.value, vocabulary(path)
            total = np.zeros_like(p)
            for batch in batches:
                seen = batch.column(0).to_pylist()
                order = sorted(range(len(seen)), key=lambda i: len(seen[i]))
                seen = [seen[i] for i in order]
                n = np.stack([batch.column(k + 1).to_numpy() for k in range(p.shape[1])], axis=1)[order]
                for lo, hi in groups(seen):
                    total += Lattice(seen[lo:hi], pieces).expected(p, n[lo:hi])
            row, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(lang), pa.array(total[row, lang])], ["piece", "lang", "n"])

        summed = words.mapInArrow(run, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        p = np.zeros_like(p)
        p[summed.column("piece").to_numpy(), summed.column("lang").to_numpy()] = summed.column("n").to_numpy()
        p = np.maximum(p / np.maximum(p.sum(axis=0), 1e-300), FLOOR)
        p[0] = FLOOR
        p /= p.sum(axis=0)
        sent.unpersist()
    return Model(path, languages, p)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs with lang_pred (a learned language or ``und``) and score (posterior of it, 0 for und)."""
    spark = docs.sparkSession
    tx.small_batches(spark)
    docs = docs.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    sent = spark.sparkContext.broadcast((model.path, model.languages, model.p))
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, languages, p = sent.value
        pieces = vocabulary(path)
        for rows, data, off in tx.slices(batches, SCORED_BYTES):
            starts, ends, bounds = tx.words(data, off)
            codes, distinct = tx.codes(data, starts, ends)
            split = [parts(w) for w in distinct]
            known = remembered(key, len(languages))
            known.score({x for s in split for x in s}, pieces, p)
            word = known.total(split)
            letter = np.array([any(map(str.isalpha, w)) for w in distinct], bool)
            n = rows.num_rows
            has = tx.total(bounds, letter[codes]) > 0 if len(codes) else np.zeros(n, bool)
            if not languages:
                has[:] = False
                best, score = np.zeros(n, np.int64), np.zeros(n)
            else:
                logs = np.stack([tx.total(bounds, word[codes, k]) if len(codes) else np.zeros(n) for k in range(len(languages))], axis=1)
                best = logs.argmax(axis=1)
                score = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            said = [languages[b] if h else "und" for b, h in zip(best.tolist(), has.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(said, pa.string()), pa.array(np.where(has, score, 0.0))], [*rows.schema.names, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double")
