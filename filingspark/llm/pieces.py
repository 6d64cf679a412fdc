"""Operator 12: byte-fallback piece vocabularies, encoded exactly by backtracking, and decoded."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from filingspark.llm.shingles import slices
from filingspark.llm.spans import coded, listed

TEXT_BYTES = 4 << 20
KNOWN_BYTES = 96 << 20
KNOWN_PAIRS = 1 << 16
LONG_WORD = 200
NEVER = 1 << 40
MARK = "▁"
_BLANK = 0x20
# The kinds of pieces in the model file, and what an unknown piece is shown as.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
UNKNOWN_SHOWN = " ⁇ "


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Numbers:
    """A map from 64-bit keys of 0 or more to numbers, looked up for whole arrays."""

    def __init__(self, entries: dict[int, int], missing: int):
        self.missing = missing
        self.bits = max(4, (4 * len(entries)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, missing, dtype=np.int64)
        rest, value = (np.fromiter(x, np.int64, len(entries)) for x in (entries.keys(), entries.values()))
        probe = 0
        while len(rest):  # each round takes the free places and leaves the rest one further
            slot = self._slot(rest, probe)
            free = self.keys[slot] < 0
            self.keys[slot[free]] = rest[free]
            mine = self.keys[slot] == rest
            self.values[slot[mine]] = value[mine]
            rest, value, probe = rest[~mine], value[~mine], probe + 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)
        return (spread.astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys, 0)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], self.missing)
        rest, probe = np.flatnonzero((there != keys) & (there >= 0)), 1
        while len(rest):
            slot = self._slot(keys[rest], probe)
            there = self.keys[slot]
            mine = there == keys[rest]
            out[rest[mine]] = self.values[slot[mine]]
            rest, probe = rest[~mine & (there >= 0)], probe + 1
        return out


class Automaton:
    """Aho-Corasick over the tokens read backwards: a text's scan from its end to its beginning
    tells for each character the longest token that begins there."""

    def __init__(self, tokens: dict[str, int]):
        self.step: dict[int, int] = {}
        own, parent, by = [-1], [0], [""]
        for text, token in tokens.items():
            state = 0
            for c in reversed(text):
                state = self.step.setdefault(state << 21 | ord(c), len(own))
                if state == len(own):
                    own.append(-1)
                    parent.append(-1)
                    by.append(c)
            own[state] = token
        depth_order = [0]
        for key, state in self.step.items():
            parent[state] = key >> 21
            depth_order.append(state)
        depth = [0] * len(own)
        for state in range(1, len(own)):  # a state's parent has a lesser number
            depth[state] = depth[parent[state]] + 1
        self.fail, self.longest = [0] * len(own), own
        for state in sorted(depth_order[1:], key=depth.__getitem__):
            if parent[state]:
                self.fail[state] = self.next(self.fail[parent[state]], by[state])
            if own[state] < 0:
                own[state] = own[self.fail[state]]
        self.steps = Numbers(self.step, -1)
        self.fails, self.longests = np.array(self.fail, dtype=np.int64), np.array(own, dtype=np.int64)

    def next(self, state: int, c: str) -> int:
        while (found := self.step.get(state << 21 | ord(c))) is None and state:
            state = self.fail[state]
        return found or 0

    def scan(self, text: str) -> list[int]:
        """The longest token that begins at each character, -1 where none does."""
        state, found = 0, []
        for c in reversed(text):
            state = self.next(state, c)
            found.append(self.longest[state])
        return found[::-1]

    def scan_all(self, points: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``scan`` of many texts side by side, the longest text first; -1 elsewhere in ``points``."""
        found = np.full(len(points) + 1, -1, dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        ends, sizes = ends[order], sizes[order]
        state = np.zeros(len(ends), dtype=np.int64)
        for back in range(1, int(sizes[0]) + 1 if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -back, side="right"))
            place, state = ends[:active] - back, state[:active]
            code = points[place]
            after = self.steps[state << 21 | code]
            rest = np.flatnonzero((after < 0) & (state > 0))
            while len(rest):
                state[rest] = self.fails[state[rest]]
                after[rest] = self.steps[state[rest] << 21 | code[rest]]
                rest = rest[(after[rest] < 0) & (state[rest] > 0)]
            state = np.maximum(after, 0)
            found[place] = self.longests[state]
        return found


class Vocabulary:
    """The pieces of a merge-type model, how each is merged, and which may stand side by side.

    Merging joins the two neighbours whose piece ranks best, the leftmost of equals, until
    no neighbours form a piece. A text's result is the only row of pieces that covers it and
    in which any two neighbours, merged anew by themselves, stay as they are.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.add_dummy_prefix
        if model.trainer_spec.model_type != 2 or not plain or not model.trainer_spec.byte_fallback:
            raise ValueError("only merge-type models with byte fallback and an identity normaliser are supported")
        if kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("user-defined and unused pieces and trailing blanks are not supported")
        names = [p.piece for p in model.pieces]
        normal = [i for i, p in enumerate(model.pieces) if p.type == NORMAL]
        self.byte_ids = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
        self.kinds = [p.type for p in model.pieces]
        #: tokens are the pieces, and after them the characters that occur in pieces without being one
        spare = sorted({c for i in normal for c in names[i]} - {names[i] for i in normal})
        self.text = [*names, *spare]
        self.ids = [(i,) for i in range(len(names))] + [self._fallback(c) for c in spare]
        self.number = {names[i]: i for i in normal} | {c: len(names) + k for k, c in enumerate(spare)}
        scores = sorted({p.score for p in model.pieces if p.type == NORMAL}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        worst = len(scores)
        self.rank = [place[p.score] if p.type == NORMAL else worst for p in model.pieces] + [worst] * len(spare)
        self.halves: dict[int, tuple[int, int]] = {}
        reached = []
        for text, token in self.number.items():
            row, last = self._merge(text)
            if row == [token]:
                reached.append(token)
                if last is not None:
                    self.halves[token] = last
        #: for each token the longest of its beginnings that is a token as well
        self.shorter: dict[int, int] = {}
        usable = {self.text[t]: t for t in reached}
        for text, token in usable.items():
            for end in range(len(text) - 1, 0, -1):
                if (found := usable.get(text[:end])) is not None:
                    self.shorter[token] = found
                    break
        self.backwards = Automaton(usable)
        self.length = [len(t) for t in self.text]
        self.inner_blank = any(MARK in names[i].lstrip(MARK) for i in normal)
        self.pairs: dict[int, bool] = {}
        self._arrays()
        self.digits = pa.array([f"{i},".encode() for i in range(len(names))], pa.binary())
        self.shown = pa.array([self._shown(i, names[i]) for i in range(len(names))], pa.binary())
        self.hidden = np.array([k in (UNKNOWN, CONTROL) for k in self.kinds])
        self.byte = np.array([k == BYTE for k in self.kinds])

    def _arrays(self) -> None:
        """The same as arrays, for many words side by side."""
        count = len(self.text)
        self.lengths = np.array(self.length, dtype=np.int64)
        self.ranks = np.array(self.rank, dtype=np.int64)
        self.shorter_of = np.full(count, -1, dtype=np.int64)
        self.shorter_of[list(self.shorter)] = list(self.shorter.values())
        self.left_of, self.right_of = np.full(count, -1, dtype=np.int64), np.full(count, -1, dtype=np.int64)
        for token, (left, right) in self.halves.items():
            self.left_of[token], self.right_of[token] = left, right
        self.byte_of = np.array(self.byte_ids, dtype=np.int32)
        self.single = np.array([len(i) == 1 for i in self.ids])
        self.alphabet = set().union(*self.number)
        pairs = {}
        for text, token in self.number.items():
            for cut in range(1, len(text)):
                left, right = self.number.get(text[:cut]), self.number.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left * count + right] = self.rank[token]
        self.joined = Numbers(pairs, NEVER)

    def _all_together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``together`` for arrays of tokens."""
        out = np.zeros(len(left), dtype=bool)
        row, limit = np.arange(len(left)), np.full(len(left), NEVER)
        while len(row):
            fits = self.joined[left * len(self.text) + right] >= limit
            undo_left, undo_right = self.right_of[left], self.left_of[right]
            whole = (undo_left < 0) & (undo_right < 0)
            out[row[fits & whole]] = True
            on = fits & ~whole
            row, left, right, undo_left, undo_right = (x[on] for x in (row, left, right, undo_left, undo_right))
            by_left, by_right = self.ranks[left], self.ranks[right]
            first = (undo_right < 0) | ((undo_left >= 0) & (by_left > by_right))
            limit = np.where(first, by_left, by_right + 1)
            left, right = np.where(first, undo_left, left), np.where(first, right, undo_right)
        return out

    def tokens_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words one after the other, and their number for each word.

        All words go on side by side, each at its own place. ``chain`` holds the token that
        ends at a place on the way there, ``failed`` the places from which no way goes on.
        """
        body = b"".join(words)
        between = next(  # a character that is in no piece and in none of the words
            c for c in map(chr, range(0x10FFFF, 0xFFFF, -1)) if c not in self.alphabet and c.encode() not in body
        )
        text = b"".join([between.encode().join(words), between.encode() if words else b""]).decode().replace(" ", MARK)
        total = len(text)
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        word_end = np.flatnonzero(points == ord(between)) + 1
        longest = self.backwards.scan_all(points, word_end - 1, np.diff(word_end, prepend=0) - 1)
        known = longest[:total] >= 0
        edge = np.diff(np.concatenate([[False], known, [False]]).astype(np.int8))
        opens, closes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        chain, failed = np.full(total + 1, -1, dtype=np.int64), np.zeros(total + 1, dtype=bool)
        start, stop, at = opens, closes, opens.copy()
        token = longest[at]
        while len(at):
            out_of = np.flatnonzero(token < 0)
            if len(out_of):
                back = at[out_of]
                if (back == start[out_of]).any():
                    raise ValueError("the vocabulary cannot be encoded by backtracking")
                failed[back] = True
                last = chain[back]
                at[out_of] = back - self.lengths[last]
                token[out_of] = self.shorter_of[last]
                continue
            end = at + self.lengths[token]
            good = ~failed[end]
            pair = np.flatnonzero(good & (at > start))
            good[pair] = self._all_together(chain[at[pair]], token[pair])
            chain[end[good]] = token[good]
            at = np.where(good, end, at)
            token = np.where(good, longest[at], self.shorter_of[token])
            left = at < stop
            if not left.all():
                start, stop, at, token = start[left], stop[left], at[left], token[left]
        final = np.full(total + 1, -1, dtype=np.int64)
        start, at = opens, closes.copy()
        while len(at):
            last = chain[at]
            final[at] = last
            at = at - self.lengths[last]
            on = at > start
            start, at = start[on], at[on]
        other = ~known
        other[word_end - 1] = False
        ends = np.flatnonzero((final >= 0) | np.append(False, other))
        tokens = final[ends]
        plain = (tokens >= 0) & self.single[tokens]
        rest = [text[e - 1] for e in ends[~plain].tolist()]  # characters shown as their bytes
        count = np.ones(len(ends), dtype=np.int64)
        count[~plain] = [len(c.encode()) for c in rest]
        ids = np.empty(int(count.sum()), dtype=np.int32)
        by_piece = np.repeat(plain, count)
        ids[by_piece] = tokens[plain]
        ids[~by_piece] = self.byte_of[np.frombuffer("".join(rest).encode(), dtype=np.uint8)]
        sums = np.append(0, np.cumsum(count))[np.searchsorted(ends, word_end)]
        return ids, np.diff(sums, prepend=0)

    def _fallback(self, text: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in text.encode())

    def _shown(self, i: int, name: str) -> bytes:
        kind = self.kinds[i]
        if kind == BYTE:
            return bytes([int(name[1:-1], 16)])
        if kind == CONTROL:
            return b""
        return (UNKNOWN_SHOWN if kind == UNKNOWN else name.replace(MARK, " ")).encode()

    def _merge(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """The tokens of a short text by plain merging, and the two halves of the last merge."""
        row, last = [self.number[c] for c in text], None
        while True:
            joined = [self.number.get(self.text[a] + self.text[b]) for a, b in zip(row, row[1:])]
            found = [(self.rank[t], i) for i, t in enumerate(joined) if t is not None]
            if not found:
                return row, last
            at = min(found)[1]
            last = (row[at], row[at + 1])
            row[at : at + 2] = [joined[at]]

    def together(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' text gives just them.

        Their merges are taken back in the reverse of the order in which they happen, the
        later of the two first. At each state, the parts that touch across the border must
        not form a piece that would have been merged before the merge just taken back: on
        equal rank, the leftmost is merged first.
        """
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(left, right)
        return known

    def _apart(self, a: int, b: int) -> bool:
        rank, text = self.rank, self.text
        limit = len(rank) + 1
        while True:
            joined = self.number.get(text[a] + text[b])
            if joined is not None and rank[joined] < limit:
                return False
            undo_a, undo_b = self.halves.get(a), self.halves.get(b)
            if undo_a is None and undo_b is None:
                return True
            if undo_b is None or (undo_a is not None and rank[a] > rank[b]):
                limit, a = rank[a], undo_a[1]
            else:
                limit, b = rank[b] + 1, undo_b[0]

    def tokens(self, word: str) -> list[int]:
        """Ids of a text in which blanks are marks already, without the mark that every text begins with."""
        longest = self.backwards.scan(word)
        shorter, length, together = self.shorter, self.length, self.together
        ids, size, base = [], len(word), 0
        failed = bytearray((size >> 3) + 1)  # a bit for each end from which no way goes on
        row: list[int] = []
        at, token = 0, longest[0] if size else -1
        while at < size:
            if longest[at] < 0:  # a character of no piece: nothing merges across it
                ids += chain.from_iterable(map(self.ids.__getitem__, row))
                ids += self._fallback(word[at])
                row, at = [], at + 1
                base = at
                token = longest[at] if at < size else -1
                continue
            while token is not None:
                end = at + length[token]
                if not failed[end >> 3] >> (end & 7) & 1 and (not row or together(row[-1], token)):
                    break
                token = shorter.get(token)
            if token is not None:
                row.append(token)
                at += length[token]
                token = longest[at] if at < size else -1
            else:
                if at == base:
                    raise ValueError("the vocabulary cannot be encoded by backtracking")
                failed[at >> 3] |= 1 << (at & 7)
                token = row.pop()
                at -= length[token]
                token = shorter.get(token)
        ids += chain.from_iterable(map(self.ids.__getitem__, row))
        return ids


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Codec:
    """Ids of texts and texts of ids; each distinct word is encoded once.

    Where no piece holds a mark behind another character, nothing merges across the
    beginning of a run of blanks, and each word with the blanks before it stands for
    itself; otherwise a whole text is one word. Known words are dropped once they hold
    ``KNOWN_BYTES``.
    """

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.bytes = 0
        self.flat = np.zeros(0, dtype=np.int32)
        self.length = np.zeros(0, dtype=np.int64)

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Short words side by side, long ones each for itself."""
        long = {i for i, w in enumerate(words) if len(w) > LONG_WORD}
        if not long:
            return self.vocabulary.tokens_of(words)
        ids, lengths = self.vocabulary.tokens_of([w for i, w in enumerate(words) if i not in long])
        short = iter(np.split(ids, np.cumsum(lengths)[:-1]))
        found = [
            np.array(self.vocabulary.tokens(w.decode().replace(" ", MARK)), np.int32) if i in long else next(short)
            for i, w in enumerate(words)
        ]
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        if self.bytes > KNOWN_BYTES:
            self._reset()
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            ids, lengths = self._ids(fresh)
            numbers[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(fresh, numbers[new].tolist()))
            self.flat, self.length = np.append(self.flat, ids), np.append(self.length, lengths)
            self.bytes += sum(map(len, fresh)) + 150 * len(fresh) + 4 * len(ids)
        return numbers

    def encoded(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(first row, ids, offsets)`` for runs of texts of about ``TEXT_BYTES``; none for NULL or empty."""
        texts = pc.replace_substring(texts.fill_null(""), MARK, " ")
        filled = pc.greater(pc.binary_length(texts), 0)
        texts = pc.if_else(filled, pc.binary_join_element_wise(" ", texts, ""), texts)
        for first, last, data, offsets in slices(texts, TEXT_BYTES):
            data = data[offsets[0] : offsets[-1]]
            cuts = offsets - offsets[0]
            if not len(data):
                yield first, np.zeros(0, dtype=np.int32), cuts
                continue
            opens = np.zeros(len(data) + 1, dtype=bool)
            if not self.vocabulary.inner_blank:
                blank = data == _BLANK
                opens[1:-1] = blank[1:] & ~blank[:-1]
            opens[cuts] = True
            starts = np.flatnonzero(opens[:-1])
            codes, words = coded(data, starts)
            number = self._numbers(listed(words))[codes]
            begin = np.cumsum(self.length) - self.length
            own = self.length[number]
            ends = np.cumsum(own)
            ids = self.flat[np.arange(int(ends[-1])) + np.repeat(begin[number] - ends + own, own)]
            yield first, ids, np.append(0, ends)[np.searchsorted(starts, cuts)]

    def decoded(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """The text of each run of ids, in UTF-8.

        Marks become blanks, but for the one that every text begins with. Bytes that are
        no UTF-8 are shown as the replacement character, each for itself.
        """
        vocabulary = self.vocabulary
        shown = vocabulary.shown.take(pa.array(ids, pa.int32()))
        places = np.frombuffer(shown.buffers()[1], dtype=np.int32)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int32)
        body = memoryview(shown.buffers()[2] or b"") if len(ids) else memoryview(b"")
        hidden, byte = vocabulary.hidden[ids], vocabulary.byte[ids]
        for a, b in zip(offsets[:-1], offsets[1:]):
            raw = bytes(body[places[a] : places[b]])
            if hidden[a:b].any() or (byte[a:b].any() and not _valid(raw)):
                yield self._shown(ids[a:b])
            else:
                yield raw[1:] if raw[:1] == b" " and not byte[a] else raw

    def _shown(self, ids: np.ndarray) -> bytes:
        vocabulary, parts, run, begun = self.vocabulary, [], bytearray(), False
        for i in [*ids.tolist(), None]:
            if i is not None and vocabulary.kinds[i] == BYTE:
                run += vocabulary.shown[i].as_py()
                begun = True
                continue
            if run:
                parts.append(_whole(bytes(run)))
                run = bytearray()
            if i is not None and vocabulary.kinds[i] != CONTROL:
                part = vocabulary.shown[i].as_py()
                if not begun and vocabulary.kinds[i] == NORMAL and part[:1] == b" ":
                    part = part[1:]
                begun = True
                parts.append(part)
        return b"".join(parts)


def _valid(run: bytes) -> bool:
    try:
        run.decode()
        return True
    except UnicodeDecodeError:
        return False


def _whole(run: bytes) -> bytes:
    """The bytes, with each byte that is no part of a character replaced."""
    if _valid(run):
        return run
    parts, at = [], 0
    while at < len(run):
        size = next((n for n in (1, 2, 3, 4) if _valid(run[at : at + n])), 0)
        parts.append(run[at : at + size] if size else "\N{REPLACEMENT CHARACTER}".encode())
        at += size or 1
    return b"".join(parts)


def _digest(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for _, ids, offsets in codec.encoded(batch.column("text")):
                joined = codec.vocabulary.digits.take(pa.array(ids, pa.int32()))
                places = np.frombuffer(joined.buffers()[1], dtype=np.int32)[: len(ids) + 1] if len(ids) else [0]
                body = memoryview(joined.buffers()[2] or b"") if len(ids) else memoryview(b"")
                for a, b in zip(offsets[:-1], offsets[1:]):
                    counts.append(int(b - a))
                    text = body[places[a] : max(places[a], places[b] - 1)]
                    of_ids.append(hashlib.sha256(text).hexdigest())
                of_text += [hashlib.sha256(t).hexdigest() for t in codec.decoded(ids, offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for first, ids, offsets in codec.encoded(batch.column("text")):
                own = batch.slice(first, len(offsets) - 1)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), lists], names=["doc_id", "ids"])

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            lists = batch.column("ids").fill_null([])
            offsets = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            texts = [t.decode() for t in codec.decoded(ids, offsets - offsets[0])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return run


def _kind(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every whole ``text``, without begin or end ids; none for NULL or empty texts.

    Repeated rows and NULL ids are kept as they are; other columns are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(_encode(path or model_path()), f"doc_id {_kind(docs)}, ids array<int>")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of every row of ``ids``; NULL ids are none."""
    rows = rows.selectExpr("doc_id", "cast(ids as array<int>) as ids")
    return rows.mapInArrow(_decode(path or model_path()), f"doc_id {_kind(rows)}, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole ``text``, encoded and decoded again.

    NULL and empty texts have no ids and the digests of nothing; repeated rows are kept;
    an empty table gives no rows.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _digest(path or model_path()),
        f"doc_id {_kind(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
