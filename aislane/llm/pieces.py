"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A merge (BPE) model's pieces are put together from characters, best-scored merge first. With dropout, every merge that
comes up is skipped with the stated chance, by its own draw: a keyed hash of seed, the document's key, the word's place in the text and
the number of the merge in the word, so the same text has several segmentations, each repeatable. A skipped pair comes up again only as part of a longer piece.
What a worker remembers is free of draws: a tree for each word, whose nodes are its pieces under some skips, with how many merges come up then.
An occurrence starts at the root and goes on to the child of its next skip as long as that merge comes up. Nodes that are new are
worked out many at a time: rows of one width make a matrix, and every step does or skips the best merge of each row.

No piece of such a model has a space behind other characters, so words are encoded one by one (checked when the model is
read). A character without a piece becomes its UTF-8 bytes, and so does the model's own space mark where a text holds it, which
the usual encoder would turn into a space. Decoding therefore gives back every text.

Defined results: a null text is empty and has no pieces. Rows that repeat id and text get the same pieces. Without dropout the pieces are those of the
sentencepiece library for every text without the space mark.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import row_key, worker_store

DROPOUT = 0.1
SEED = 20_240
# Skips of the first so many merges are remembered, one bit a merge. Words with later ones are worked out each time.
_BITS = 64
# Words that are merged together.
_TOGETHER = 50_000
# The draws say after how many merges the next one is skipped, up to so many at once.
_GAPS = 256
# Fixed value: the mark that stands for a space in pieces.
SPACE = "▁"
# Chunks that are merged on their own. Where no piece joins a letter with a full stop or comma behind it, and none
# holds a line break, texts are cut there too: fewer different chunks.
_WORDS = re.compile(r" *[^ ]+| +")
_PLAIN = r"[^ \n.,]++"
_TAIL = rf"(?:[.,]++{_PLAIN})*+(?:(?<=[^\W\d_])(?=[.,](?:[ \n]|$))|[.,]*+)"
_FINE_WORDS = re.compile(rf" *{_PLAIN}(?:(?=[ \n])|{_TAIL})| *[.,]++(?:{_PLAIN}{_TAIL})?|\n+| +")
_LONG = 48
_MASK = (1 << 64) - 1


class PieceModel:
    """Pieces and scores of a merge model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.piece: dict[int, str] = {}
        self.byte_id = [0] * 256
        self.raw: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError("a piece goes across words")
                self.id[piece], self.score[piece], self.piece[i] = i, model.get_score(i), piece
                self.raw.append(piece.replace(SPACE, " ").encode())
        joined = any(a.isalpha() and b in ".," for p in self.id for a, b in zip(p, p[1:], strict=False))
        self.chunks = _WORDS if joined or any("\n" in p for p in self.id) else _FINE_WORDS

    def decode(self, ids) -> str:
        """The text of ``ids``; the space put before every text is taken off again."""
        data = b"".join(map(self.raw.__getitem__, ids))
        return data[1:].decode() if data else ""


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.size = np.zeros(1024, dtype=kind), 0

    @property
    def all(self) -> np.ndarray:
        return self.room[: self.size]

    def add(self, values: np.ndarray) -> int:
        """Put ``values`` at the end; where they begin."""
        begin, self.size = self.size, self.size + len(values)
        if self.size > len(self.room):
            wider = np.zeros(max(self.size, 2 * len(self.room)), dtype=self.room.dtype)
            wider[:begin] = self.room[:begin]
            self.room = wider
        self.room[begin : self.size] = values
        return begin


class _Known:
    """Segmentations met so far. Each word has a tree of them: the root has no skip, and a node's child adds one behind its last."""

    def __init__(self):
        self.root: dict[str, int] = {}
        # Words: their characters' pieces; a length of 0 marks those in ``odd``, which the matrices don't take.
        self.odd: dict[int, str] = {}
        self.symbols, self.symbol_begin, self.length = _Grown(np.int32), _Grown(np.int64), _Grown(np.int32)
        # Nodes: word, skips as bits, merges that come up, pieces. ``child`` plus a skip is a place in ``children``, -1 where not worked out.
        self.word, self.mask, self.steps = _Grown(np.int32), _Grown(np.uint64), _Grown(np.int32)
        self.pieces, self.begin, self.count = _Grown(np.uint32), _Grown(np.int64), _Grown(np.int32)
        self.children, self.child = _Grown(np.int32), _Grown(np.int64)

    def add_nodes(self, words, masks, after, steps, counts, flat) -> np.ndarray:
        """New nodes whose children's skips are ``after`` or later."""
        begin = self.pieces.add(flat)
        self.begin.add(begin + np.cumsum(counts) - counts)
        self.count.add(counts)
        self.mask.add(masks)
        self.steps.add(steps)
        slots = np.maximum(np.minimum(steps, _BITS) - after, 0)
        self.child.add(self.children.add(np.full(slots.sum(), -1, np.int32)) + np.cumsum(slots) - slots - after)
        return self.word.add(words) + np.arange(len(words))


class Encoder:
    """Encodes texts; ``dropout`` 0 gives the model's plain segmentation."""

    # Some 100 bytes each; beyond, all are worked out anew as they come up.
    MOST_WORDS, MOST_NODES = 400_000, 2_000_000

    def __init__(self, model: PieceModel, dropout: float = DROPOUT, seed: int = SEED):
        self.model, self.seed = model, seed
        self.size = len(model.raw)
        # What part of the draws go on after so many merges, rising.
        self.goes_on = np.array([int((1 - dropout) ** (g + 1) * 2**53) for g in range(_GAPS)][::-1], dtype=np.uint64)
        self.known = _Known()
        self._pairs()

    def _gaps(self, words: np.ndarray, number: int | np.ndarray) -> np.ndarray:
        """How many merges go well before the next skip, by the words' hashes and the number of the draw; ``_GAPS`` or more are ``_GAPS``."""
        h = words + np.asarray(number, dtype=np.uint64) * np.uint64(0x165667B19E3779F9)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = (h ^ (h >> np.uint64(31))) >> np.uint64(11)
        return _GAPS - np.searchsorted(self.goes_on, h, side="right")

    def _all_skips(self, word: int) -> Iterator[int]:
        """The numbers of all merges skipped in a word, rising, by the word's hash."""
        at, begin = 0, 0
        while True:
            numbers = np.arange(begin, begin + 64, dtype=np.uint64)
            for gap in self._gaps(np.full(64, word, dtype=np.uint64), numbers).tolist():
                at += gap
                if gap < _GAPS:
                    yield at
                    at += 1
            begin += 64

    def _pairs(self) -> None:
        """All pairs of pieces that merge, as rising numbers, with the rank of the merged piece; characters by code point."""
        ids, found = self.model.id, []
        for piece, number in ids.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    found.append((left * self.size + right, number))
        found.sort()
        # The last place stands for pairs that don't merge.
        self.pair_keys = np.array([k for k, _ in found] + [2**62], dtype=np.int64)
        self.pair_piece = np.array([n for _, n in found] + [0], dtype=np.int32)
        scores = sorted({self.model.score[self.model.piece[n]] for _, n in found}, reverse=True)
        rank, self.none = {score: r for r, score in enumerate(scores)}, len(scores)
        self.pair_rank = np.array([rank[self.model.score[self.model.piece[n]]] for _, n in found] + [self.none], dtype=np.int32)
        # -1 where several pieces have the score: runs of spaces do.
        self.piece_of_rank = np.zeros(self.none + 1, dtype=np.int32)
        self.piece_of_rank[self.pair_rank] = self.pair_piece
        self.piece_of_rank[self.pair_rank[self.piece_of_rank[self.pair_rank] != self.pair_piece]] = -1
        # A table for pairs of characters. Only those that some pair joins have a place of their own, the rest share place 0.
        ones = np.zeros(self.size, dtype=bool)
        ones[[number for piece, number in ids.items() if len(piece) == 1]] = True
        left, right = self.pair_keys[:-1] // self.size, self.pair_keys[:-1] % self.size
        at = np.flatnonzero(ones[left] & ones[right])
        joined = np.unique(np.r_[left[at], right[at]])
        self.single = np.zeros(self.size, dtype=np.int32)
        self.single[joined] = np.arange(1, len(joined) + 1)
        self.rank_of_singles = np.full((len(joined) + 1, len(joined) + 1), self.none, dtype=np.int32)
        self.rank_of_singles[self.single[left[at]], self.single[right[at]]] = self.pair_rank[at]
        self.char = np.full(0x110000, -1, dtype=np.int32)
        for piece, number in ids.items():
            if len(piece) == 1 and piece != SPACE:
                self.char[ord(piece)] = number
        self.char[ord(" ")] = ids.get(SPACE, -1)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where a pair stands among those that merge, the last place if it doesn't."""
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, at, len(self.pair_keys) - 1)

    def _merge_rows(self, words: np.ndarray, masks: np.ndarray, steps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and their pieces, many rows at a time. Bit t of a row's mask skips its merge t; ``steps`` counts those that came up.

        Rows of one width are a matrix. Those that merge join the rows that are one narrower.
        """
        known = self.known
        lengths, begin = known.length.all[words], known.symbol_begin.all[words]
        widest = int(lengths.max(initial=0))
        by_length = np.argsort(lengths, kind="stable")
        cuts = np.searchsorted(lengths[by_length], np.arange(1, widest + 2))
        narrower: list[tuple] = []
        for width in range(widest, 0, -1):
            same, narrower = narrower, []
            starting = by_length[cuts[width - 1] : cuts[width]]
            if len(starting):
                symbols = known.symbols.all[begin[starting][:, None] + np.arange(width)]
                short = self.single[symbols]
                same.append((starting, symbols, self.rank_of_singles[short[:, :-1], short[:, 1:]], masks[starting]))
            if not same:
                continue
            rows, symbols, ranks, left = same[0] if len(same) == 1 else map(np.concatenate, zip(*same, strict=True))
            if width == 1:
                yield rows, symbols
                return
            while len(rows):
                best = ranks.argmin(axis=1)
                lowest = ranks[np.arange(len(rows)), best]
                live = lowest < self.none
                if not live.all():
                    yield rows[~live], symbols[~live]
                    rows, symbols, ranks, left, best, lowest = (x[live] for x in (rows, symbols, ranks, left, best, lowest))
                steps[rows] += 1
                skipped = (left & np.uint64(1)).astype(bool)
                left = left >> np.uint64(1)
                if not skipped.any():
                    narrower.append((rows, *self._merged(symbols, ranks, best, lowest), left))
                    break
                done = ~skipped
                if done.any():
                    narrower.append((rows[done], *self._merged(symbols[done], ranks[done], best[done], lowest[done]), left[done]))
                rows, symbols, ranks, left, best = (x[skipped] for x in (rows, symbols, ranks, left, best))
                ranks[np.arange(len(rows)), best] = self.none

    def _merged(self, symbols: np.ndarray, ranks: np.ndarray, best: np.ndarray, lowest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows with their pair at ``best`` merged."""
        each, width = np.arange(len(symbols)), symbols.shape[1]
        # What stands right of the merge moves one place left.
        right = np.arange(width - 1) > best[:, None]
        merged = self.piece_of_rank[lowest]
        tied = np.flatnonzero(merged < 0)
        if len(tied):
            merged[tied] = self.pair_piece[self._find(symbols[tied, best[tied]], symbols[tied, best[tied] + 1])]
        symbols = np.where(right, symbols[:, 1:], symbols[:, :-1])
        symbols[each, best] = merged
        ranks = np.where(right[:, :-1], ranks[:, 1:], ranks[:, :-1])
        behind, before = np.flatnonzero(best < width - 2), np.flatnonzero(best > 0)
        r, c = np.concatenate((behind, before)), np.concatenate((best[behind], best[before] - 1))
        ranks[r, c] = self.pair_rank[self._find(symbols[r, c], symbols[r, c + 1])]
        return symbols, ranks

    def _work_out(self, words: np.ndarray, masks: np.ndarray, after: np.ndarray) -> np.ndarray:
        """New nodes: the pieces of words with the merges of their masks skipped."""
        known, n = self.known, len(words)
        steps, counts, parts = np.zeros(n, np.int32), np.zeros(n, np.int32), []
        odd = known.length.all[words] == 0
        plain = np.flatnonzero(~odd)
        own = np.zeros(len(plain), np.int32)
        for rows, pieces in self._merge_rows(words[plain], masks[plain], own):
            counts[plain[rows]] = pieces.shape[1]
            parts.append((plain[rows], pieces))
        steps[plain] = own
        for i in np.flatnonzero(odd).tolist():
            data, steps[i] = self._encoded(known.odd[int(words[i])], _set_bits(int(masks[i])))
            pieces = np.frombuffer(data, "<u4")[None, :]
            counts[i] = pieces.shape[1]
            parts.append((np.array([i]), pieces))
        begin, flat = np.cumsum(counts, dtype=np.int64) - counts, np.zeros(counts.sum(dtype=np.int64), np.uint32)
        for rows, pieces in parts:
            flat[begin[rows][:, None] + np.arange(pieces.shape[1])] = pieces
        return known.add_nodes(words, masks, after, steps, counts, flat)

    def _learn(self, chunks: list[str]) -> None:
        """Remember new chunks, without skips."""
        known = self.known
        lengths = np.array(list(map(len, chunks)), dtype=np.int32)
        # A lone surrogate has no piece, so it can't be lost here.
        ids = self.char[np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4").astype(np.int64)]
        begin = np.cumsum(lengths, dtype=np.int64) - lengths
        plain = (np.minimum.reduceat(ids, begin) >= 0) & (lengths <= _LONG)
        words = known.length.size + np.arange(len(chunks))
        known.odd |= {int(words[i]): chunks[i] for i in np.flatnonzero(~plain).tolist()}
        known.length.add(np.where(plain, lengths, 0))
        known.symbol_begin.add(known.symbols.add(ids) + begin)
        nodes = self._work_out(words, np.zeros(len(chunks), np.uint64), np.zeros(len(chunks), np.int64))
        known.root.update(zip(chunks, nodes.tolist(), strict=True))

    def _roots(self, chunks: list[str]) -> np.ndarray:
        """The nodes of chunks without skips; new chunks are merged together."""
        nodes = np.fromiter(map(self.known.root.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(nodes < 0)
        if len(missing):
            own = [chunks[i] for i in missing.tolist()]
            new = list(dict.fromkeys(own))
            for begin in range(0, len(new), _TOGETHER):
                self._learn(new[begin : begin + _TOGETHER])
            nodes[missing] = np.fromiter(map(self.known.root.__getitem__, own), np.int64, len(own))
        return nodes

    def _with_skip(self, nodes: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """The children of nodes by their next skip; those not met before are worked out together."""
        known = self.known
        at = known.child.all[nodes] + skip
        new = np.flatnonzero(known.children.all[at] < 0)
        if len(new):
            slots, first = np.unique(at[new], return_index=True)
            parents, skips = nodes[new[first]], skip[new[first]]
            for begin in range(0, len(slots), _TOGETHER):
                part = slice(begin, begin + _TOGETHER)
                masks = known.mask.all[parents[part]] | np.uint64(1) << skips[part].astype(np.uint64)
                made = self._work_out(known.word.all[parents[part]], masks, skips[part] + 1)
                known.children.all[slots[part]] = made
        return known.children.all[at].astype(np.int64)

    def _symbols(self, chunk: str) -> list[str]:
        # A text's own space mark stays apart from the spaces: no piece holds a NUL with something else.
        return [SPACE if c == " " else "\0" + SPACE if c == SPACE else c for c in chunk]

    def _merge_long(self, symbols: list[str | None], skips: Iterator[int]) -> tuple[list[str], int]:
        """One chunk with an agenda: for long ones, and those with characters that have no piece."""
        n, step, skip = len(symbols), 0, next(skips, -1)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < n:
                piece = symbols[left] + symbols[after[left]]
                gain = self.model.score.get(piece)
                if gain is not None:
                    heapq.heappush(agenda, (-gain, left, piece))

        for i in range(n):
            offer(i)
        while agenda:
            _, left, piece = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] is None or right >= n or symbols[left] + symbols[right] != piece:
                continue
            step += 1
            if step - 1 == skip:
                skip = next(skips, -1)
                continue
            symbols[left], symbols[right] = piece, None
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            offer(left)
            offer(before[left])
        return [s for s in symbols if s is not None], step

    def _encoded(self, chunk: str, skips: Iterator[int]) -> tuple[bytes, int]:
        model, out = self.model, []
        pieces, steps = self._merge_long(self._symbols(chunk), skips)
        for piece in pieces:
            known = model.id.get(piece)
            if known is not None:
                out.append(known)
            else:
                out += [model.byte_id[b] for b in piece.removeprefix("\0").encode() or b"\0"]
        return np.array(out, "<u4").tobytes(), steps

    def _words(self, key: int, count: int) -> np.ndarray:
        """A hash of each of a text's words by its place."""
        h = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= np.uint64((key ^ self.seed * 0x2545F4914F6CDD1D) & _MASK)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))

    def encode(self, text: str, key: int = 0) -> np.ndarray:
        return next(self.encode_all([text], [key]))

    def encode_all(self, texts: list[str], keys: list[int]) -> Iterator[np.ndarray]:
        """The pieces of every text; what is new in them is merged together."""
        if len(self.known.root) > self.MOST_WORDS or self.known.word.size > self.MOST_NODES:
            self.known = _Known()
        known, chunks, words, ends = self.known, [], [], [0]
        for text, key in zip(texts, keys, strict=True):
            own = self.model.chunks.findall(" " + text) if text else []
            chunks += own
            words.append(self._words(key, len(own)))
            ends.append(len(chunks))
        hashes = np.concatenate([*words, np.zeros(0, np.uint64)])
        nodes = self._roots(chunks)
        skip = self._gaps(hashes, 0)
        active, number = np.flatnonzero(skip < known.steps.all[nodes]), 0
        skip = skip[active]
        while len(active):
            number += 1
            # Beyond what a mask holds, or a gap tells, a word is worked out with all its skips.
            far = skip >= _BITS
            for i in active[far].tolist():
                data, steps = self._encoded(chunks[i], self._all_skips(int(hashes[i])))
                pieces = np.frombuffer(data, "<u4")
                one = np.array([0])
                nodes[i] = known.add_nodes(one, one, one, one, np.array([len(pieces)]), pieces)[0]
            active, skip = active[~far], skip[~far]
            nodes[active] = self._with_skip(nodes[active], skip)
            skip = skip + 1 + self._gaps(hashes[active], number)
            more = skip < known.steps.all[nodes[active]]
            active, skip = active[more], skip[more]
        counts = known.count.all[nodes].astype(np.int64)
        bounds = np.r_[0, np.cumsum(counts)]
        flat = known.pieces.all[np.repeat(known.begin.all[nodes] - bounds[:-1], counts) + np.arange(bounds[-1])]
        for begin, end in zip(ends, ends[1:], strict=False):
            yield flat[bounds[begin] : bounds[end]]


def _set_bits(mask: int) -> Iterator[int]:
    return (bit for bit in range(mask.bit_length()) if mask >> bit & 1)


def encode_documents(
    docs: DataFrame,
    model_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    dropout: float = DROPOUT,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``piece_ids array<int>`` and ``decoded``, the text got back from them, added."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, name = worker_store(), (model_path, dropout, seed)
        encoder = store[name] = store.get(name) or Encoder(PieceModel(model_path), dropout, seed)
        model = encoder.model
        for batch in batches:
            keys = batch.column(batch.num_columns - 2).to_pylist()
            texts = batch.column(batch.num_columns - 1).to_pylist()
            ids = list(encoder.encode_all(texts, keys))
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 pa.array([model.decode(i.tolist()) for i in ids], pa.string())],
                [*batch.schema.names[:-2], "_piece_ids", "_decoded"],
            )

    renamed = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    own_id, text = f"_c{docs.columns.index(id_column)}", f"_c{docs.columns.index(text_column)}"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in renamed.schema)
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = renamed.withColumns({"_key": row_key(own_id, text), "_plain": plain})
    coded = keyed.mapInArrow(encode, f"{schema}, _piece_ids array<int>, _decoded string")
    own = [F.col(f"_c{i}").alias(n) for i, n in enumerate(docs.columns)]
    return coded.select(*own, F.col("_piece_ids").alias("piece_ids"), F.col("_decoded").alias("decoded"))
