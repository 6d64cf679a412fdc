"""Token ids of a public byte-level BPE vocabulary, one encoding per distinct word."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from filingspark.llm.shingles import slices
from filingspark.llm.spans import LETTER, SPACE, coded, kinds_of, listed

CACHED_WORDS = 300_000
TEXT_BYTES = 1 << 20
BLANK, APOSTROPHE = 0x20, 0x27
# Endings that the vocabulary's word pattern keeps with their apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: themselves if they can be seen, else from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


@cache
def _merger(path: str) -> Callable[[bytes], list[int]]:
    """Ids of a single word.

    Where every merge of the file makes the token of the next number, the number ranks the
    merge, and a word needs no more than the ranks; another file's words go to the tokenizer.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters, merges = _byte_letters(), [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get("".join(m)) for m in merges]
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    if not plain or model.get("ignore_merges") or made != list(range(256, 256 + len(made))):
        encode = _tokenizer(path)
        return lambda word: encode.encode(word.decode(), add_special_tokens=False).ids
    import tiktoken

    ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(made)}
    return tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def word_starts(points: np.ndarray, kinds: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Where the words of the vocabulary's pattern begin; ``opens`` marks the texts' first characters.

    A word is a run of one kind with at most one blank before it. Of a longer white
    space the last character stands apart, or joins the next word if it is a blank;
    white space at the end of a text stays whole. An ending such as ``'ll`` is a word
    where a lone apostrophe follows anything but a blank.
    """
    count = len(points)
    first = np.zeros(count + 1, dtype=bool)
    first[opens] = True
    first[count] = True
    fresh = first[:count].copy()
    fresh[1:] |= kinds[1:] != kinds[:-1]
    space = kinds == SPACE
    follows = np.zeros(count, dtype=bool)  # a character of the same text that is no space
    follows[:-1] = ~space[1:] & ~first[1:count]
    after_blank = np.zeros(count, dtype=bool)
    after_blank[1:] = (points[:-1] == BLANK) & ~first[1:count]
    starts = (fresh & (space | ~after_blank)) | (space & follows)
    lone = starts & (points == APOSTROPHE)
    at = np.flatnonzero(lone[:-1] & (kinds[1:] == LETTER) & ~first[1:count])
    for ending in ENDINGS:
        fits = at + len(ending) < count
        for step, letter in enumerate(ending, 1):
            there = np.minimum(at + step, count - 1)
            fits &= (points[there] == ord(letter)) & ~first[there]
        own = at[fits]
        starts[own + 1] = False
        after = own + 1 + len(ending)
        after = after[after < count]
        starts[after[(kinds[after] == LETTER) & ~first[after]]] = True
    return starts


class Encoder:
    """Ids of texts; each distinct word is encoded once and looked up from then on.

    Made for one task, since a worker that waits for its next one should not hold on to
    its words; beyond ``CACHED_WORDS`` they are dropped and encoded anew.
    """

    def __init__(self, path: str):
        self.encode, self.merge = _tokenizer(path), _merger(path)
        self.special = [t.content for t in self.encode.get_added_tokens_decoder().values()]
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, dtype=np.uint32)
        self.begin = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) + len(words) > CACHED_WORDS:
            self._reset()
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            ids = list(map(self.merge, fresh))
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self.begin = np.append(self.begin, len(self.flat) + np.cumsum(lengths) - lengths)
            self.length = np.append(self.length, lengths)
            self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())))
            numbers[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(fresh, numbers[new].tolist()))
        return numbers

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, as the tokenizer gives them; none for NULL."""
        for first, last, data, offsets in slices(texts, TEXT_BYTES):
            data = data[offsets[0] : offsets[-1]]
            opens = offsets - offsets[0]
            if not len(data):
                yield from (np.zeros(0, dtype=np.uint32) for _ in range(last - first))
                continue
            points, kinds, places = kinds_of(data)
            inner = np.searchsorted(places, opens[:-1][opens[:-1] < len(data)])
            starts = places[word_starts(points, kinds, inner)]
            codes, words = coded(data, starts)
            number = self._numbers(listed(words))[codes]
            lengths = self.length[number]
            ends = np.cumsum(lengths)
            gather = np.arange(int(ends[-1])) + np.repeat(self.begin[number] - ends + lengths, lengths)
            flat = self.flat[gather]
            cuts = np.append(0, ends)[np.searchsorted(starts, opens)]
            raw = data.tobytes()
            odd = any(s.encode() in raw for s in self.special)
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                text = raw[opens[i] : opens[i + 1]] if odd else b""
                if odd and any(s.encode() in text for s in self.special):
                    own = self.encode.encode(text.decode(), add_special_tokens=False).ids
                    yield np.array(own, dtype=np.uint32)
                else:
                    yield flat[a:b]
