"""SentencePiece (BPE) encoding and decoding in vectorised merge rounds.

Texts are cut into words that no piece spans. The symbols of all words lie in one flat numpy array;
each round finds the least pair rank of every word (a segmented minimum), merges that pair
wherever it stands, leftmost first, and compacts the array, until no word has a pair left. Words met
before are looked up. In long words the rounds look only at the places of the round's pairs.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: Words of more characters are merged one by one, by :meth:`PieceModel.merge_long`.
LONG_WORD = 512
#: Words kept with their ids by a task, and characters encoded in one go.
MEMO_WORDS, ROUND_CHARS = 200_000, 1_000_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NONE = np.int64(1) << 62


class PieceModel:
    """Tables of a BPE model: built on the driver, sent to the tasks (a few MB, as large as the vocabulary)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("a BPE model without text normalisation is needed")
        if any(p.type in (USER, UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces aren't supported")
        if sum(p.type == BYTE for p in model.pieces) != 256:
            raise ValueError("a model with byte pieces is needed")
        self.dummy_prefix = spec.add_dummy_prefix
        self.pieces = [(p.piece, p.score, p.type) for p in model.pieces]

    def build(self) -> None:
        """Derived tables; each task builds them once."""
        self.id_of = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.unknown = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        long = [p for p in self.id_of if len(p) > 1]
        chars = sorted(set("".join(long)))
        # symbols: pieces by id, then characters that only occur inside pieces
        self.symbol = dict(self.id_of)
        for c in chars:
            self.symbol.setdefault(c, len(self.pieces) + len(self.symbol))
        scores = sorted({self.pieces[self.id_of[p]][1] for p in long}, reverse=True)
        rank_of = {s: i for i, s in enumerate(scores)}
        tied = {s: 0 for s in scores}
        for p in long:
            tied[self.pieces[self.id_of[p]][1]] += 1
        left, right, made, rank, one = [], [], [], [], {}
        for p in long:
            score = self.pieces[self.id_of[p]][1]
            one.setdefault(p, tied[score] > 1)
            for i in range(1, len(p)):
                a, b = self.symbol.get(p[:i]), self.symbol.get(p[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(self.id_of[p]), rank.append(rank_of[score])
                    for part in (p[:i], p[i:]):  # a merge that can be followed by a better one is done one at a time
                        if len(part) > 1 and score >= self.pieces[self.id_of[part]][1]:
                            one[part] = True
        self.width = len(self.pieces) + len(self.symbol) + 1
        keys = np.array(left, np.int64) * self.width + np.array(right, np.int64)
        order = np.argsort(keys)
        self.pair, self.made, self.rank = keys[order], np.array(made, np.int64)[order], np.array(rank, np.int64)[order]
        self.pair_index = {k: i for i, k in enumerate(self.pair.tolist())}
        self.single = np.zeros(self.width, bool)
        self.single[[self.id_of[p] for p, x in one.items() if x]] = True
        body = "".join(re.escape(c) for c in chars if c != SPACE)
        run = self._greedy_run()
        self.words = re.compile((f"{SPACE}{{{run}}}(?={SPACE})|" if run else "") + (f"{SPACE}*[{body}]+|{SPACE}+|(?s:.)" if self._space_leads(long) else f"[{body}{SPACE}]+|(?s:.)"))
        self.memo: dict[str, bytes] = {}
        self.bytes_of = [self._as_bytes(p, kind) for p, _, kind in self.pieces]

    @staticmethod
    def _space_leads(long: list[str]) -> bool:
        """Whether no piece has a space behind another character: words then begin at spaces."""
        return not any(a != SPACE and b == SPACE for p in long for a, b in zip(p, p[1:]))

    def _greedy_run(self) -> int:
        """Longest piece of spaces, if all shorter ones exist too, with one score below all others: a
        run of spaces then fills up from the left, so whole lengths can be split off."""
        runs = {len(p): self.pieces[i][1] for p, i in self.id_of.items() if set(p) == {SPACE} and len(p) > 1}
        most = max(runs, default=0)
        rest = [self.pieces[i][1] for p, i in self.id_of.items() if len(p) > 1 and set(p) != {SPACE}]
        inner = any(SPACE * 2 in p and set(p) != {SPACE} for p in self.id_of)
        good = most and set(runs) == set(range(2, most + 1)) and len(set(runs.values())) == 1 and max(runs.values()) < min(rest) and not inner
        return most if good else 0

    def _as_bytes(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(SPACE, " ").encode()

    # ---- encoding ----

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over flat symbols of consecutive words, until no pair remains in any."""
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        place = np.arange(len(symbols))
        while len(symbols):
            keys = np.append(symbols[:-1] * self.width + symbols[1:], -1)
            keys[:-1][word[1:] != word[:-1]] = -1
            at = np.minimum(np.searchsorted(self.pair, keys), len(self.pair) - 1)
            rank = np.where(self.pair[at] == keys, self.rank[at], NONE)
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[heads, len(word)])
            best = np.repeat(np.minimum.reduceat(rank, heads), sizes)
            open_ = best < NONE
            if not open_.all():
                done.append((place[~open_], symbols[~open_], word[~open_]))
            hit = open_ & (rank == best)
            hits = np.flatnonzero(hit)
            if len(hits):
                # of overlapping pairs every second one; where a better merge may follow, the first of the word
                fresh = np.r_[True, hits[1:] != hits[:-1] + 1]
                run = np.flatnonzero(fresh)
                nth = np.arange(len(hits)) - np.repeat(run, np.diff(np.r_[run, len(hits)]))
                first = np.r_[True, word[hits[1:]] != word[hits[:-1]]]
                hits = hits[(nth % 2 == 0) & (first | ~self.single[self.made[at[hits]]])]
                symbols = symbols.copy()
                symbols[hits] = self.made[at[hits]]
                open_[hits + 1] = False
            symbols, word, place = symbols[open_], word[open_], place[open_]
        place, symbols, word = (np.concatenate(x) for x in zip(*done)) if done else (place, symbols, word)
        order = np.argsort(place, kind="stable")
        return symbols[order], word[order]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The rounds of :meth:`merge` for one long word: positions are filed under the rank of the
        pair that begins there, and a round takes the least rank that is present, merges its pairs
        and ranks only their neighbours anew. Pairs after which a better merge may follow are merged
        one at a time, the leftmost first."""
        n = len(symbols)
        symbols, after, before = symbols.copy(), np.arange(1, n + 1), np.arange(-1, n - 1)
        rank, made, dead = np.full(n, NONE), np.zeros(n, np.int64), np.zeros(n, bool)
        filed: dict[int, list[np.ndarray]] = {}
        queued: dict[int, list[int]] = {}  # ranks of single merges: a heap of positions
        ranks: list[int] = []
        index = self.pair_index

        def file(at: np.ndarray) -> None:
            rank[at] = NONE
            at = at[after[at] < n]
            keys = symbols[at] * self.width + symbols[after[at]]
            found = np.minimum(np.searchsorted(self.pair, keys), len(self.pair) - 1)
            ok = self.pair[found] == keys
            at, found = at[ok], found[ok]
            rank[at], made[at] = self.rank[found], self.made[found]
            order = np.argsort(rank[at], kind="stable")
            at = at[order]
            r = rank[at]
            begin = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(at) else []
            for x, y in zip(begin, [*begin[1:], len(at)]):
                own = int(r[x])
                if own in queued or self.single[made[at[x:y]]].any():
                    if own not in queued:
                        queued[own] = np.concatenate(filed.pop(own)).tolist() if own in filed else heapq.heappush(ranks, own) or []
                    queued[own] += at[x:y].tolist()
                    heapq.heapify(queued[own])
                elif own in filed:
                    filed[own].append(at[x:y])
                else:
                    filed[own] = [at[x:y]]
                    heapq.heappush(ranks, own)

        def file_one(p: int) -> None:
            q = int(after[p])
            found = index.get(int(symbols[p]) * self.width + int(symbols[q]), -1) if q < n else -1
            if found < 0:
                rank[p] = NONE
                return
            own = int(self.rank[found])
            rank[p], made[p] = own, self.made[found]
            if own in queued:
                heapq.heappush(queued[own], p)
            elif own in filed:
                if self.single[made[p]]:
                    queued[own] = [*np.concatenate(filed.pop(own)).tolist(), p]
                    heapq.heapify(queued[own])
                else:
                    filed[own].append(np.array([p]))
            else:
                heapq.heappush(ranks, own)
                if self.single[made[p]]:
                    queued[own] = [p]
                else:
                    filed[own] = [np.array([p])]

        file(np.arange(n))
        while ranks:
            now = ranks[0]
            if now in queued:
                heap = queued[now]
                if not heap:
                    heapq.heappop(ranks)
                    del queued[now]
                    continue
                p = heapq.heappop(heap)
                if dead[p] or rank[p] != now:
                    continue
                q = int(after[p])
                symbols[p] = made[p]
                dead[q], rank[q] = True, NONE
                end = after[p] = after[q]
                if end < n:
                    before[end] = p
                file_one(p)
                if before[p] >= 0:
                    file_one(int(before[p]))
                continue
            heapq.heappop(ranks)
            hits = np.unique(np.concatenate(filed.pop(now)))
            hits = hits[(rank[hits] == now) & ~dead[hits]]
            if not len(hits):
                continue
            run = np.flatnonzero(np.r_[True, hits[1:] != after[hits[:-1]]])
            nth = np.arange(len(hits)) - np.repeat(run, np.diff(np.r_[run, len(hits)]))
            a = hits[nth % 2 == 0]
            b = after[a]
            symbols[a] = made[a]
            dead[b], rank[b] = True, NONE
            after[a] = after[b]
            inner = after[a] < n
            before[after[a][inner]] = a[inner]
            left = before[a]
            file(np.unique(np.r_[a, left[left >= 0]]))
        return symbols[~dead]

    def encode_long(self, word: str) -> bytes:
        """Ids (packed int32) of one long word."""
        get, n = self.symbol.get, self.width - 1
        merged = self.merge_long(np.fromiter((get(c, n) for c in word), np.int64, len(word)))
        if (merged >= len(self.pieces)).any():
            merged, _ = self._as_byte_pieces(merged, np.zeros(len(merged), np.int64), word)
        return merged.astype(np.int32).tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (packed int32) of each word."""
        flat = "".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        get, n = self.symbol.get, self.width - 1
        symbols = np.fromiter((get(c, n) for c in flat), np.int64, len(flat))
        word = np.repeat(np.arange(len(words)), sizes)
        merged, of = self.merge(symbols, word)
        if (merged >= len(self.pieces)).any():
            merged, of = self._as_byte_pieces(merged, of, flat)
        ends = np.cumsum(np.bincount(of, minlength=len(words))).tolist()
        packed = merged.astype(np.int32).tobytes()
        return [packed[4 * x:4 * y] for x, y in zip([0, *ends], ends)]

    def _as_byte_pieces(self, symbols: np.ndarray, word: np.ndarray, flat: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters left over without a piece become their UTF-8 bytes. Lengths of the symbols
        before a leftover say which character it is."""
        left = symbols >= len(self.pieces)
        length = np.array([len(p) for p, _, _ in self.pieces], np.int64)
        span = np.where(left, 1, length[np.where(left, 0, symbols)])
        start = np.cumsum(span) - span
        data = [[self.byte_id[b] for b in flat[i].encode()] for i in start[left].tolist()]
        counts = np.ones(len(symbols), np.int64)
        counts[left] = [len(x) for x in data]
        out = np.repeat(symbols, counts)
        out[np.repeat(left, counts)] = np.fromiter(chain.from_iterable(data), np.int64)
        return out, np.repeat(word, counts)

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return self.words.findall((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Words met before are looked up in ``memo``, which is emptied when full."""
        out, memo = [], self.memo
        for group in _portions(texts):
            split = [self.split(t) for t in group]
            fresh = list({w for ws in split for w in ws if w not in memo})
            long = {w: self.encode_long(w) for w in fresh if len(w) > LONG_WORD}  # not kept: a few would fill the memory
            fresh = [w for w in fresh if len(w) <= LONG_WORD]
            for lo in range(0, len(fresh), 100_000):
                memo.update(zip(fresh[lo:lo + 100_000], self.encode_words(fresh[lo:lo + 100_000])))
            known = memo.__getitem__ if not long else lambda w: long[w] if w in long else memo[w]
            out += [np.frombuffer(b"".join(map(known, ws)), np.int32) for ws in split]
            if len(memo) > MEMO_WORDS:
                memo.clear()
        return out

    # ---- decoding ----

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the model's own library gives it: bytes that are no UTF-8 become U+FFFD
        each, the dummy prefix goes."""
        if not len(ids):
            return ""
        numbers = ids.tolist()
        data = b"".join([self.bytes_of[i] for i in numbers])
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = self._decode_broken(numbers)
        lead = next((self.pieces[i] for i in numbers if self.pieces[i][2] != CONTROL), ("", 0, CONTROL))
        return text[1:] if self.dummy_prefix and lead[2] == NORMAL and lead[0][0] == SPACE else text

    def _decode_broken(self, ids: list[int]) -> str:
        out, held = [], b""
        for i in [*ids, None]:
            if i is not None and self.pieces[i][2] == BYTE:
                held += self.bytes_of[i]
                continue
            while held:
                n = next((n for n in range(1, min(4, len(held)) + 1) if _is_char(held[:n])), 0)
                out.append(held[:n].decode() if n else "�")
                held = held[max(n, 1):]
            if i is not None:
                out.append(self.bytes_of[i].decode())
        return "".join(out)


def _is_char(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def _portions(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= ROUND_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _in_tasks(docs: DataFrame, model_path: str):
    """The model for tasks: its vocabulary is broadcast, tables are built in each task."""
    return docs.sparkSession.sparkContext.broadcast(PieceModel(model_path))


def _ready(shared) -> PieceModel:
    model = shared.value
    if not hasattr(model, "pair"):
        model.build()
    return model


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with a column ``ids`` (array of int): the pieces of column ``text``, without begin or end
    ids; with ``decoded`` also a column of that name, the text that the ids decode to.

    Null and empty texts: an empty array. Every row is encoded; the other columns stay; a column
    that is already called so raises ValueError. Empty table: empty result."""
    added = [ids, decoded] if decoded else [ids]
    if {c.lower() for c in added} & {c.lower() for c in docs.columns}:
        raise ValueError(f"a column of {added} exists")
    shared, at = _in_tasks(docs, model_path), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, at):
                model = _ready(shared)
                encoded = model.encode([t or "" for t in part.column(at).to_pylist()])
                ends = np.r_[0, np.cumsum([len(e) for e in encoded])].astype(np.int32)
                new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(encoded), pa.int32()))]
                if decoded:
                    new.append(pa.array([model.decode(e) for e in encoded], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *added])

    kinds = (T.ArrayType(T.IntegerType()), T.StringType())
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *[T.StructField(c, kind) for c, kind in zip(added, kinds)]]))


def _slices(batch: pa.RecordBatch, at: int, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0).to_numpy()
    part = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def decode_documents(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with a string column ``text``: the text of the array column ``ids`` (null: empty)."""
    shared, at = _in_tasks(df, model_path), df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            model = _ready(shared)
            flat, ends = b.column(at).values.to_numpy(zero_copy_only=False), b.column(at).offsets.to_numpy()
            out = [model.decode(flat[x:y]) for x, y in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, text])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(text, T.StringType())]))


def digests(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens, ids_sha256, decoded_sha256 of every row: the texts are encoded, then decoded from their ids."""
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    done = encode_documents(rows, model_path, "_text", "_ids", "_decoded")
    return done.select(key, F.size("_ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2(F.col("_decoded"), 256).alias("decoded_sha256"))
