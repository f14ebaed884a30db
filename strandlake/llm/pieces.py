"""SentencePiece encoding and decoding as weighted finite-state transduction.

Three machines are compiled from a model file into arc tables:
  - the normaliser writes U+2581 for a space and before a text that isn't empty, and every other character as it is;
  - the piece machine is a trie over characters: arcs (state, character) -> state, and a final state writes its piece;
  - the byte fallback reads a character that is no piece by itself and writes the ids of its UTF-8 bytes.
Composing them with an input gives a lattice: states are the places between its characters, arcs the pieces (or fallback
characters) that span them. The composition is lazy: only arcs that some input has are looked up. The encoding is the
shortest path in the tropical semiring: places are relaxed in order by (min, +), then walked back.

For a unigram model an arc weighs minus the piece's log probability. A BPE model has no weights whose cheapest path is its
encoding, so a further acceptor is composed: its states are pieces, and an arc from one piece to the next weighs 0 where
the pair is stable (merging its characters by rank gives back the pair) and infinity elsewhere. An encoding is what
merging gives exactly if all its adjacent pairs are stable, so one path of finite weight is left, and one state at each
place. Pairs are tried on demand, many at once, and kept.

All words of a batch that have no path yet are composed and relaxed together, so each step is one of array arithmetic. No
piece crosses a newline, or a U+2581 after another character, where the vocabulary has none that does (checked when the
model is read); so a text's lattice is a chain of lattices of its words, and a word's path is found once. The words of a
step have at most STEP characters together, a longer word is alone; memory is linear in them. Paths of words over SHORT
characters are not kept.

Decoding runs the inverse machines: each id writes its characters or byte, then the normaliser is undone. Null and empty
texts have no ids and decode to the empty text; texts of any length are read whole; of two paths of one weight that whose
arcs begin earlier wins. Repeated rows give repeated results; an empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, table

SPACE = "▁"
#: The default vocabulary; a parameter everywhere.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Paths, and pairs, that a process keeps.
KEPT = 500_000
#: Characters of the longest word whose path is kept, and of the words that are composed in one step.
SHORT, STEP = 64, 1 << 17
#: Characters of the parts in which a long word is relaxed.
CHUNK = 512
_CHARS = 0x110000
_UNKNOWN = repeat(-1)


class Arcs:
    """An arc table: int64 keys to rows of values; key_of says how a state and a label make a key."""

    def __init__(self, rows: dict[int, tuple[int, ...]], width: int):
        keys = np.fromiter(rows, np.int64, len(rows))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.array(list(rows.values()), np.int64).reshape(-1, width)[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1) if len(self.keys) else np.full(len(keys), -1)


class Transducer:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        rule = spec.normalizer_spec
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only the identity normaliser is compiled")
        self.prefix = SPACE if rule.add_dummy_prefix else ""
        self.normal = {" ": SPACE}
        self.bpe = spec.trainer_spec.model_type == proto.TrainerSpec.BPE
        kind = proto.ModelProto.SentencePiece
        text = [p.piece for p in spec.pieces]
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == kind.UNKNOWN)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == kind.BYTE}
        self.piece = {p.piece: i for i, p in enumerate(spec.pieces) if p.type in (kind.NORMAL, kind.USER_DEFINED)}
        self.n = len(text)
        raw = {i: bytes([b]) for b, i in self.bytes.items()}
        self.written = [raw.get(i) or x.encode() for i, x in enumerate(text)]
        alone = not any(re.search(f"[^{SPACE}]{SPACE}|\n", s) and len(s) > 1 for s in self.piece)
        self.word = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n") if alone else re.compile("(?s).+")
        self.paths: dict[str, bytes] = {}
        self.stable: dict[int, bool] = {}
        self._compile_pieces()
        score = {s: spec.pieces[i].score for s, i in self.piece.items()}
        self.weight = np.zeros(self.n)
        self.weight[list(self.piece.values())] = [-x for x in score.values()]
        self.fallback_weight = 10 - min(score.values())
        if self.bpe:
            self._compile_merges(score)

    def _compile_pieces(self) -> None:
        """The trie: node 0 is the root, a key is node * _CHARS + character, a value is the next node."""
        arcs: dict[int, tuple[int]] = {}
        final = {}
        for s, i in self.piece.items():
            node = 0
            for c in s:
                node = arcs.setdefault(node * _CHARS + ord(c), (len(arcs) + 1,))[0]
            final[node] = i
        self.trie = Arcs(arcs, 1)
        self.final = np.full(len(arcs) + 1, -1, np.int32)
        self.final[list(final)] = list(final.values())
        self.root = np.full(_CHARS, -1, np.int32)  # the arcs of the root, by character
        first = self.trie.keys < _CHARS
        self.root[self.trie.keys[first]] = self.trie.values[first, 0]

    def _compile_merges(self, score: dict[str, float]) -> None:
        """What merging knows: a symbol is a piece, or n + the character where that is none; a key is left * (n + _CHARS)
        + right, values are the merged piece and its rank, least first."""
        symbol = lambda s: self.piece[s] if s in self.piece else self.n + ord(s) if len(s) == 1 else None
        ranks = {x: k for k, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.wide = self.n + _CHARS
        arcs = {}
        for s, i in self.piece.items():
            for k in range(1, len(s)):
                left, right = symbol(s[:k]), symbol(s[k:])
                if left is not None and right is not None:
                    arcs[left * self.wide + right] = (i, ranks[score[s]])
        self.merges = Arcs(arcs, 2)
        spelled = [[symbol(c) for c in s] for s in self.piece]
        ids = np.array(list(self.piece.values()), np.int64)
        self.spelled = np.array([c for x in spelled for c in x], np.int64)
        self.spelled_size, self.spelled_at = np.ones(self.n, np.int64), np.zeros(self.n, np.int64)
        self.spelled_size[ids] = [len(x) for x in spelled]
        self.spelled_at[ids] = np.cumsum([0] + [len(x) for x in spelled])[:-1]
        self.in_pieces = np.unique(np.array([ord(c) for s in self.piece for c in s], np.int64))

    def _characters(self, symbols: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """A row of at most `most` character symbols for each symbol, and how many it has."""
        known = np.minimum(symbols, self.n - 1)
        size = np.where(symbols < self.n, self.spelled_size[known], 1)
        at = np.minimum(self.spelled_at[known][:, None] + np.arange(most), len(self.spelled) - 1)
        return np.where((symbols < self.n)[:, None], self.spelled[at], symbols[:, None]), size

    def merged_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of each pair of symbols by rank gives back the pair; many pairs at once."""
        none = np.iinfo(np.int64).max
        most = int(self.spelled_size.max())
        (left, n_left), (right, n_right) = self._characters(a, most), self._characters(b, most)
        width = int((n_left + n_right).max()) + 1
        place = np.arange(width)
        chars = np.take_along_axis(np.concatenate((left, right, np.full((len(a), 1), -1)), axis=1), np.where(place < n_left[:, None], np.minimum(place, most - 1), np.where(place < (n_left + n_right)[:, None], np.clip(place - n_left[:, None], 0, most - 1) + most, 2 * most)), axis=1)

        def look(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            row = self.merges.find(np.where((x >= 0) & (y >= 0), x * self.wide + y, -1))
            return self.merges.values[row, 0], np.where(row >= 0, self.merges.values[row, 1], none)

        to, rank = look(chars[:, :-1].ravel(), chars[:, 1:].ravel())
        to, rank = to.reshape(len(a), -1), rank.reshape(len(a), -1)
        out, rows = np.zeros(len(a), bool), np.arange(len(a))
        while len(rows):
            at = rank.argmin(axis=1)  # of equal ranks the leftmost merges first
            each = np.arange(len(rows))
            live = rank[each, at] < none
            done = ~live
            out[rows[done]] = (chars[done, 0] == a[rows[done]]) & (chars[done, 1] == b[rows[done]]) & (chars[done, 2] < 0 if width > 2 else True)
            rows, chars, to, rank, at = rows[live], chars[live], to[live], rank[live], at[live]
            if not len(rows):
                break
            each = np.arange(len(rows))
            new = to[each, at]
            shift = lambda m, k: np.take_along_axis(m, np.minimum(np.arange(m.shape[1]) + (np.arange(m.shape[1]) > k[:, None]), m.shape[1] - 1), axis=1)
            chars, to, rank = shift(chars, at), shift(to, at), shift(rank, at)
            chars[each, at] = new
            chars[:, -1] = -1
            to[each, at], rank[each, at] = look(new, chars[each, np.minimum(at + 1, width - 1)])
            rank[:, -1] = none
            before = np.flatnonzero(at > 0)
            to[before, at[before] - 1], rank[before, at[before] - 1] = look(chars[before, at[before] - 1], new[before])
        return out

    def _are_stable(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """The acceptor's arcs: True where piece may follow before (-1: nothing)."""
        keys = before * self.wide + piece
        whole = (before < 0) | ((piece >= self.n) & ~np.isin(piece - self.n, self.in_pieces))  # what no piece holds never merges
        out = np.ones(len(keys), bool)
        ask = np.flatnonzero(~whole)
        found = np.fromiter(map(self.stable.get, keys[ask].tolist(), _UNKNOWN), np.int8, len(ask))
        missing = ask[found < 0]
        if len(missing):
            if len(self.stable) > KEPT:
                self.stable.clear()
            new, back = np.unique(keys[missing], return_inverse=True)
            told = self.merged_pairs(new // self.wide, new % self.wide)
            self.stable.update(zip(new.tolist(), told.tolist(), strict=True))
            found[found < 0] = told[back]
        out[ask] = found > 0
        return out

    def compose(self, codes: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All arcs of the lattices of words that stand one after another: place, length and symbol.

        limit is the end of each character's word."""
        place = np.arange(len(codes))
        node = self.root[codes]
        piece = np.where(node >= 0, self.final[node], -1)
        fallback = piece < 0
        arcs = [(place, np.ones(len(codes), np.int64), np.where(fallback, codes + self.n, piece).astype(np.int64))]
        live = node >= 0
        place, node, size = place[live], node[live].astype(np.int64), 1
        while len(place):
            inside = place + size < limit[place]
            place, node = place[inside], node[inside]
            row = self.trie.find(node * _CHARS + codes[place + size])
            place, node = place[row >= 0], self.trie.values[row[row >= 0], 0]
            size += 1
            ends = self.final[node] >= 0
            arcs.append((place[ends], np.full(int(ends.sum()), size), self.final[node[ends]].astype(np.int64)))
        return tuple(map(np.concatenate, zip(*arcs, strict=True)))

    def _relaxed(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of each word (a word of n characters has n + 1) the last symbol on the shortest path to it and
        the characters that it spans; and where each word's places begin."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        place, size, symbol = self.compose(codes, ends[word])
        step = place - (ends - sizes)[word[place]]
        order = np.argsort(step, kind="stable")
        cuts = np.searchsorted(step[order], np.arange(int(sizes.max(initial=0)) + 1))
        start = (place + word[place])[order]
        size, symbol = size[order], symbol[order]
        best = np.full(len(codes) + len(words), np.inf)
        last, span = np.full(len(best), -1), np.zeros(len(best), np.int64)
        begins = ends - sizes + np.arange(len(words))
        best[begins] = 0.0
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at, arc = start[low:high], symbol[low:high]
            to = at + size[low:high]
            if self.bpe:
                weight = np.where(self._are_stable(last[at], arc), 0.0, np.inf)
            else:
                weight = np.where(arc < self.n, self.weight[np.minimum(arc, self.n - 1)], self.fallback_weight)
            reached = best[at] + weight
            better = reached < best[to]  # arcs of one step end in different places
            to = to[better]
            best[to], last[to], span[to] = reached[better], arc[better], size[low:high][better]
        return last, span, begins

    def shortest_paths(self, words: list[str]) -> list[bytes]:
        """The ids (int32) on each word's shortest path."""
        if len(words) == 1 and self.bpe and len(words[0]) > 2 * CHUNK:
            return [self._long_path(words[0])]
        last, span, begins = self._relaxed(words)
        at = begins + np.fromiter(map(len, words), np.int64, len(words))
        who, found, symbols = np.arange(len(at)), [], []
        while len(who):  # from the ends back to the beginnings
            left = at > begins[who]
            who, at = who[left], at[left]
            found.append(who)
            symbols.append(last[at])
            at = at - span[at]
        word, symbol = np.concatenate(found), np.concatenate(symbols)
        order = np.lexsort((-np.arange(len(word)), word))
        word, symbol = self._spelled_out(word[order], symbol[order])
        packed, cuts = symbol.tobytes(), 4 * np.searchsorted(word, np.arange(len(words) + 1))
        return [packed[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _long_path(self, word: str, chunk: int = CHUNK) -> bytes:
        """The ids of one long word: its chunks, each with some of the next, are relaxed together, as if each began a text.

        The state at a place depends on those of the places that a piece reaches back to. So where a chunk's states
        agree on that many places with those from before, they are the word's own from there on. Where they never
        agree (repeats), this chunk and those after it are cut anew from the last place before it where the path so far begins
        a piece, first one, then ever more; if they don't agree then, larger chunks are tried, in the end the whole word."""
        reach = int(self.spelled_size.max())
        last, span = np.full(len(word) + 1, -1), np.zeros(len(word) + 1, np.int64)
        known = begin = 0  # the places up to `known` have their states
        most = width = max(1, STEP // (chunk + 8 * reach))
        while begin < len(word):
            some = [(b, word[b : b + chunk + 8 * reach]) for b in range(begin, len(word), chunk)[:width]]
            own_last, own_span, at = self._relaxed([x for _, x in some])
            for (b, x), i in zip(some, at.tolist(), strict=True):
                end = b + len(x)
                if b and end > known and not self._agree(own_last[i : i + len(x) + 1], last[b : known + 1], reach):
                    break
                if end > known:  # places from the agreement on, up to `known`, have these states already
                    last[known + 1 : end + 1], span[known + 1 : end + 1] = (own[i + known - b + 1 : i + len(x) + 1] for own in (own_last, own_span))
                    known = end
            else:
                begin, width = some[-1][0] + chunk, min(most, 2 * width)
                continue
            to = known
            while to > b:
                to -= int(span[to])
            if width == 1 or to == b:
                return self._long_path(word, 8 * chunk)
            begin, width = to, 1
        back, sizes, at, symbols = last.tolist(), span.tolist(), len(word), []
        while at:
            symbols.append(back[at])
            at -= sizes[at]
        return self._spelled_out(np.zeros(len(symbols), np.int64), np.array(symbols[::-1], np.int64))[1].tobytes()

    @staticmethod
    def _agree(new: np.ndarray, known: np.ndarray, reach: int) -> bool:
        """Whether states from one place on agree with those known, on `reach` places running."""
        n = min(len(new), len(known))
        total = np.concatenate(([0], np.cumsum(new[1:n] == known[1:n])))
        return len(total) > reach and bool((total[reach:] - total[:-reach] == reach).any())

    def _spelled_out(self, word: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols as ids (int32), fallback characters as their bytes; and the word of each."""
        odd = np.flatnonzero(symbol >= self.n)
        if len(odd):
            ids = lambda c: [self.bytes.get(b, self.unknown) for b in chr(c).encode()] if self.bytes else [self.unknown]
            spelled = list(map(ids, (symbol[odd] - self.n).tolist()))
            counts = np.ones(len(symbol), np.int64)
            counts[odd] = [len(x) for x in spelled]
            wide = np.repeat(symbol, counts)
            wide[np.repeat(symbol >= self.n, counts)] = [x for y in spelled for x in y]
            word, symbol = np.repeat(word, counts), wide
        return word, symbol.astype(np.int32)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids (int32) of each text."""
        words = []
        for t in texts:
            for a, b in self.normal.items():
                t = t.replace(a, b) if t else ""
            words.append(self.word.findall(self.prefix + t) if t else [])
        paths = self.paths
        missing = {w for ws in words for w in ws if w not in paths}
        if len(paths) + len(missing) > KEPT and len(paths):
            paths.clear()
            missing = {w for ws in words for w in ws}
        once: dict[str, bytes] = {}  # the paths of long words go with their batch
        group: list[str] = []
        size = 0
        for w in sorted(missing, key=len):
            if group and size + len(w) > STEP:
                self._keep(group, once)
                group, size = [], 0
            group.append(w)
            size += len(w)
        if group:
            self._keep(group, once)
        return [b"".join([paths[w] if w in paths else once[w] for w in ws] if once else map(paths.__getitem__, ws)) for ws in words]

    def _keep(self, words: list[str], once: dict[str, bytes]) -> None:
        for w, path in zip(words, self.shortest_paths(words), strict=True):
            (self.paths if len(w) <= SHORT else once)[w] = path

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_all([text])[0], np.int32)

    def decode(self, ids: list[int]) -> str:
        joined = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace")
        joined = joined.removeprefix(self.prefix) if self.prefix else joined
        for a, b in self.normal.items():
            joined = joined.replace(b, a)
        return joined


_READY: dict[int, Transducer] = {}


def _transducer(model: bytes) -> Transducer:
    """One for each process and model."""
    key = hash(model)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Transducer(model)
    return _READY[key]


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in packed]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def encode_documents(docs: DataFrame, model: bytes, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to keep and ids (array<int>) of every row. The model, some 500 KB, goes along with the tasks."""
    kept = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", *keep]

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _transducer(kept.value)
        for batch in in_slices(it, 256):
            ids = _lists(t.encode_all(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), ids], [*names, "ids"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(encode, f"{kinds}, ids array<int>")


def decode_ids(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and text of rows with ids."""
    kept = encoded.sparkSession.sparkContext.broadcast(model)

    def decode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _transducer(kept.value)
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([t.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def round_trips(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids, the SHA-256 of the text that the ids decode to, and whether that is the text itself (null as empty,
    U+2581 as the space that the normaliser can't tell it from) of every row; both ways in one pass."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def both(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _transducer(kept.value)
        for batch in in_slices(it, 256):
            texts = batch.column("text").to_pylist()
            packed = t.encode_all(texts)
            back = [t.decode(memoryview(x).cast("i").tolist()) if x else "" for x in packed]
            digests = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string())
            same = pa.array([x == (y or "").replace(SPACE, " ") for x, y in zip(back, texts, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(packed), digests, same], ["doc_id", "ids", "decoded_sha256", "round_trips"])

    return docs.select("doc_id", "text").mapInArrow(both, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded_sha256 string, round_trips boolean")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trips(table(spark, sf_dir, "documents"), read_model())
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256", "round_trips")
