"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts are cut where no merge can cross: before a word's space mark, around line breaks and inside
runs of spaces. Distinct words of a batch that the task has not met are merged together, as one flat
array of symbols: each round finds the best pair of every word, applies all of its leftmost
occurrences at once, and compacts the array, until no pair is left. The encoder of a task remembers
words it has merged, up to a bound.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SPACE = "▁"
#: No pair: larger than any rank.
NONE = np.int64(1) << 40
#: A task forgets its merged words beyond this number, and merges this many characters at once.
KNOWN_WORDS = 250_000
MERGE_CHARS = 250_000
CUT = re.compile(f"{SPACE}?[^{SPACE}\n]+|\n+|{SPACE}+(?={SPACE}[^{SPACE}\n])|{SPACE}+")


class Pieces:
    """Vocabulary of a SentencePiece BPE model with byte pieces and identity normalisation.

    Symbols are numbered: pieces by id, characters that are no piece behind them.
    """

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        vocabulary = SentencePieceProcessor(model_file=model)
        n = vocabulary.get_piece_size()
        kept = [i for i in range(n) if not (vocabulary.is_byte(i) or vocabulary.is_control(i) or vocabulary.is_unknown(i))]
        self.size = n
        self.end = vocabulary.eos_id()
        self.ids = {vocabulary.id_to_piece(i): i for i in kept}
        self.bytes = np.array([vocabulary.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if not all(vocabulary.is_byte(int(i)) for i in self.bytes) or vocabulary.normalize("ﬁ  a ") != f"{SPACE}ﬁ{SPACE}{SPACE}a{SPACE}":
            raise ValueError("only models with byte pieces and identity normalisation are supported")
        # Rank of a merged piece: pieces of higher score first, equal scores are equal.
        scores = np.array([vocabulary.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        # All pairs of pieces that make a piece, sorted for searching.
        pairs = [(self.ids[p[:c]], self.ids[p[c:]], i) for p, i in self.ids.items() for c in range(1, len(p)) if p[:c] in self.ids and p[c:] in self.ids]
        left, right, merged = np.array(sorted(pairs), np.int64).T
        self.keys, self.merged = left * n + right, merged
        self.number = np.arange(n, n + 0x110000)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.number[ord(p)] = i
        self.space = self.ids[SPACE]
        lengths = {k for k in range(1, 64) if SPACE * k in self.ids}
        self.longest_run = max(lengths)
        runs = {self.rank[self.ids[SPACE * k]] for k in lengths - {1}}
        others = max(self.rank[i] for p, i in self.ids.items() if len(p) > 1 and p.strip(SPACE))
        if len(runs) != 1 or min(runs) <= others or any(SPACE in p.lstrip(SPACE) or (p[:2] == SPACE * 2 and p.strip(SPACE)) or "\n" in p for p in self.ids):
            raise ValueError("space marks of this model do not separate words")
        self.runs = [self._grown([1] * k, lengths) for k in range(self.longest_run + 1)]
        if len(self.runs[-1]) != 1:
            raise ValueError("runs of space marks of this model do not grow to the longest one")
        # What a piece adds to decoded text.
        texts = [b""] * n
        for p, i in self.ids.items():
            texts[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes):
            texts[i] = bytes([b])
        texts[vocabulary.unk_id()] = " ⁇ ".encode()
        self.texts = texts

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece each pair makes; ``NONE`` where it makes none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left < self.size) & (right < self.size)
        piece = np.where(found, self.merged[at], 0)
        return np.where(found, self.rank[piece], NONE), piece

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row and how many each has, merged as the library does: best rank
        first, leftmost among equals. Words are not empty."""
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        symbol = self.number[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, piece = self._ranks(symbol, word)
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, first)
            length = np.diff(np.r_[first, len(symbol)])
            open_word = best < NONE
            if not open_word.all():  # words without a pair leave the array
                stays = np.repeat(open_word, length)
                done.append((word[~stays], symbol[~stays]))
                symbol, word, rank, piece = symbol[stays], word[stays], rank[stays], piece[stays]
                best, length = best[open_word], length[open_word]
                if not len(symbol):
                    break
            chosen = self._leftmost(rank == np.repeat(best, length))
            chosen = self._without_conflicts(symbol, word, rank, piece, chosen)
            symbol[chosen] = piece[chosen]
            keep = np.r_[True, ~chosen[:-1]]
            symbol, word, rank, piece = symbol[keep], word[keep], rank[keep], piece[keep]
            merged = chosen[keep]
            # Only pairs with a merged symbol are new.
            changed = np.flatnonzero(merged | np.r_[merged[1:], False])
            rank[changed], piece[changed] = self._ranks_at(symbol, word, changed)
        return self._split(done, len(words))

    def _ranks_at(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        right = np.minimum(at + 1, len(symbol) - 1)
        rank, piece = self.pair_ranks(symbol[at], symbol[right])
        rank[(word[right] != word[at]) | (right == at)] = NONE
        return rank, piece

    def _ranks(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._ranks_at(symbol, word, np.arange(len(symbol)))

    @staticmethod
    def _leftmost(candidate: np.ndarray) -> np.ndarray:
        """Of candidates in a row, which overlap, every other one from the left."""
        at = np.arange(len(candidate))
        start = candidate & ~np.r_[False, candidate[:-1]]
        return candidate & ((at - np.maximum.accumulate(np.where(start, at, -1))) % 2 == 0)

    def _without_conflicts(self, symbol, word, rank, piece, chosen) -> np.ndarray:
        """Keep all merges of a word unless one makes a pair that comes before the next merge.

        One merge after another, the library would then take that pair first; such a word keeps its
        leftmost merge alone in this round.
        """
        at = np.flatnonzero(chosen)
        several = np.flatnonzero(word[at][1:] == word[at][:-1])  # followed by another in its word
        if not len(several):
            return chosen
        at_now, level = at[several], rank[at[several]]
        made = piece[at_now]
        after = self.pair_ranks(made, symbol[at_now + 2])[0]  # there is one: the next merge
        before = np.full(len(at_now), NONE)
        has = np.flatnonzero((at_now > 0) & (word[np.maximum(at_now - 1, 0)] == word[at_now]))
        left = at_now[has] - 1
        joined = chosen[np.maximum(left - 1, 0)] & (left > 0)
        left_symbol = np.where(joined, piece[np.maximum(left - 1, 0)], symbol[left])
        before[has] = self.pair_ranks(left_symbol, made[has])[0]
        risky = np.unique(word[at_now[(after <= level) | (before <= level)]])
        if not len(risky):
            return chosen
        in_risky = np.isin(word[at], risky)
        not_first = np.r_[False, word[at][1:] == word[at][:-1]]
        chosen = chosen.copy()
        chosen[at[in_risky & not_first]] = False
        return chosen

    def _split(self, done: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids per word; characters that are no piece become their bytes."""
        word = np.concatenate([w for w, _ in done])
        symbol = np.concatenate([s for _, s in done])
        order = np.argsort(word, kind="stable")
        word, symbol = word[order], symbol[order]
        if (unknown := symbol >= self.size).any():
            points, inverse = np.unique(symbol[unknown], return_inverse=True)
            spelled = [self.bytes[list(chr(p - self.size).encode())] for p in points]
            length = np.ones(len(symbol), np.int64)
            length[unknown] = np.array([len(s) for s in spelled])[inverse]
            ends = np.cumsum(length)
            ids = np.repeat(symbol, length)
            word = np.repeat(word, length)
            flat = np.concatenate(spelled)
            starts = np.cumsum([0] + [len(s) for s in spelled[:-1]])[inverse]
            counts = length[unknown]
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            ids[np.repeat(ends[unknown] - counts, counts) + inner] = flat[np.repeat(starts, counts) + inner]
            symbol = ids
        return symbol.astype(np.int32), np.bincount(word, minlength=n)

    def _grown(self, run: list[int], lengths: set[int]) -> np.ndarray:
        """Ids of a short run: all merges are equal, so the leftmost possible one comes first."""
        while at := next((i + 1 for i in range(len(run) - 1) if run[i] + run[i + 1] in lengths), 0):
            run[at - 1 : at + 1] = [run[at - 1] + run[at]]
        return np.array([self.ids[SPACE * k] for k in run], np.int32)

    def run(self, n: int) -> list[np.ndarray]:
        """Ids of ``n`` space marks in a row: the left one grows to the longest, then the next."""
        full = self.longest_run
        return [self.runs[full]] * (n // full) + [self.runs[n % full]]

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: the first piece loses the space mark that encoding put in front; control
        pieces add nothing; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Encoder:
    """Encodes batches of texts and remembers the words it has merged."""

    def __init__(self, model: str):
        self.pieces = Pieces(model)
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        flats, counts, start = [self.flat], [self.counts], 0
        ends = np.cumsum([len(w) for w in words]) if words else []
        while start < len(words):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + MERGE_CHARS, "right")))
            flat, count = self.pieces.merge_words(words[start:stop])
            flats.append(flat)
            counts.append(count)
            start = stop
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))
        self.flat, self.counts = np.concatenate(flats), np.concatenate(counts)
        self.starts = np.cumsum(self.counts) - self.counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text without an end id. No text, no ids."""
        cut = [CUT.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        distinct = set().union(*cut)
        runs = {w for w in distinct if w[-1] == SPACE}
        if len(self.index) > KNOWN_WORDS:
            self._forget()
        self._learn([w for w in distinct - runs if w not in self.index])
        plain = [words if runs.isdisjoint(words) else [] for words in cut] if runs else cut
        at = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(plain)), np.int64)
        counts = self.counts[at]
        ends = np.cumsum(counts)
        ids = self.flat[np.repeat(self.starts[at] - ends + counts, counts) + np.arange(counts.sum())]
        cuts = np.r_[0, ends][np.cumsum([len(words) for words in plain])]
        out = np.split(ids, cuts[:-1])
        if runs:
            out = [self._with_runs(w) if w and not p else x for w, p, x in zip(cut, plain, out)]
        return out

    def _with_runs(self, words: list[str]) -> np.ndarray:
        """A word's space mark that merged with nothing belongs to the run of marks before it."""
        parts: list[np.ndarray] = []
        run = 0
        for w in words:
            if w[-1] == SPACE:
                run += len(w)
                continue
            i = self.index[w]
            ids = self.flat[self.starts[i] : self.starts[i] + self.counts[i]]
            if run and ids[0] == self.pieces.space:
                run += 1
                ids = ids[1:]
            if run:
                parts += self.pieces.run(run)
            run = 0
            parts.append(ids)
        return np.concatenate(parts + self.pieces.run(run))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``MERGE_CHARS`` bytes together, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + MERGE_CHARS, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _encode_task(batches: Iterable[pa.RecordBatch], model: str, decoded: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(model)
    end = np.array([encoder.pieces.end], np.int32)
    for batch in batches:
        for part in _parts(batch):
            keys, texts = part.column(0), part.column(1).to_pylist()
            ids = [np.concatenate([x, end]) for x in encoder.encode(texts)]
            offsets = np.cumsum([0] + [len(x) for x in ids], dtype=np.int32)
            out = [keys, pa.ListArray.from_arrays(offsets, np.concatenate(ids))]
            if decoded:
                out.append(pa.array([encoder.pieces.decode(x.tolist()) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(out, ["key", "ids", "decoded"][: len(out)])


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``key`` and ``ids``, with the end id and no other addition, for each row of ``docs``.

    With ``decoded`` also the text the ids stand for. Null and empty texts have the end id alone.
    Rows are independent of one another, and other columns are ignored. ``model`` is the path of the
    model's file on all executors.
    """
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, ids array<int>" + ", decoded string" * decoded

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encode_task(batches, model, decoded)

    return rows.mapInArrow(task, schema).withColumnRenamed("key", key)


def _decode_task(batches: Iterable[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    pieces = Pieces(model)
    for batch in batches:
        texts = [None if ids is None else pieces.decode(ids) for ids in (x.as_py() for x in batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text`` of ``ids``; null ids give null, no ids the empty text."""
    rows = encoded.select(encoded[key].alias("key"), encoded[ids].cast("array<int>").alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decode_task(batches, model)

    return rows.mapInArrow(task, f"key {kind}, text string").withColumnRenamed("key", key)
