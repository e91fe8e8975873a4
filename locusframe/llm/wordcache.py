"""Encodes whole texts by their distinct chunks.

A text is cut only where the tokenizer itself always cuts: before a single space that a
visible character follows (byte-level BPE) or at every space (the word BPE, which drops white
space). Each distinct chunk is encoded once and kept per Python worker, and gathered with numpy; a
full cache keeps what was seen more than once. A text that holds the content of an added token is
encoded whole, as that content may stand anywhere in it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Trailing marks that always start a new pre-token after a letter in both vocabularies' patterns.
TAIL = ".,*%$#&!?;:"
#: Letters that stay one letter when normalised and lower-cased (others may end in a combining mark, which takes marks behind it along).
PLAIN = r"[A-Za-zÀ-ÖØ-öø-ÿ]$"

#: Words that begin and end with what is surely no white space under any Unicode version.
ENDS = r"(?s)^[\x21-\x7e\p{L}](.*[\x21-\x7e\p{L}])?$"


def visible(c: str) -> bool:
    """Surely no white space under any Unicode version."""
    return "\x21" <= c <= "\x7e" or c.isalpha()


class ChunkEncoder:
    """encode_many(list of str) gives all ids in one array and the number of each; spaced says that a space belongs
    to the next word. whole(str) gives the ids of a text that has one of the strings `added`."""

    def __init__(self, encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], spaced: bool, limit: int = 700_000, added: Sequence[str] = (), whole: Callable[[str], Sequence[int]] | None = None):
        self.encode_many, self.spaced, self.limit, self.added, self.whole = encode_many, spaced, limit, added, whole
        self.entry: dict[str, int] = {"": 0}
        self.flat = np.zeros(0, np.uint32)
        self.first, self.size, self.hits = (np.zeros(1, np.int64) for _ in range(3))

    def _shrink(self) -> None:
        """Only entries that were asked for in more than one slice stay; if that leaves too many, none do."""
        keep = self.hits > 1
        keep[0] = True
        if keep.sum() > self.limit // 2:
            keep[1:] = False
        number = np.cumsum(keep) - 1
        kept = keep.tolist()
        self.entry = {k: n for (k, e), n in zip(self.entry.items(), number[list(self.entry.values())].tolist(), strict=True) if kept[e]}
        self.flat = gather(self.flat, self.first[keep], self.size[keep])
        self.size, self.hits = self.size[keep], self.hits[keep]
        self.first = np.cumsum(self.size) - self.size

    def _entries(self, parts: list[str]) -> np.ndarray:
        """The entry of each part; new ones are encoded."""
        have = self.entry
        at = np.fromiter(map(have.get, parts, repeat(-1)), np.int64, len(parts))
        if len(missing := np.flatnonzero(at < 0)):
            new = list(dict.fromkeys([parts[i] for i in missing.tolist()]))
            flat, lens = self.encode_many(new)
            have.update(zip(new, range(len(self.first), len(self.first) + len(new)), strict=True))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(lens) - lens])
            self.size = np.concatenate([self.size, lens])
            self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int64)])
            self.flat = np.concatenate([self.flat, flat])
            at[missing] = [have[parts[i]] for i in missing.tolist()]
        self.hits[at] += 1  # once for all mentions in a call
        return at

    def _chunks(self, text: str) -> list[str]:
        """The cut at spaces, for a text whose spaces and line ends don't each stand between visible characters."""
        out = [""]
        for i, w in enumerate(text.split(" ")):
            if i and w and visible(w[0]):
                out.append(" " + w)
            else:
                out[-1] += " " * bool(i) + w
        return out

    def _chunk_ids(self, parts: list[str]) -> np.ndarray:
        at = self._entries(parts)
        return gather(self.flat, self.first[at], self.size[at])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text (null: none)."""
        if len(self.entry) > self.limit:
            self._shrink()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        special = np.zeros(len(texts), bool)
        for content in self.added:
            special |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if special.any():
            return self._with_special(texts, special)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        start = lists.offsets.to_numpy()
        per_text, begin = np.diff(start), (start[:-1] - start[0])
        words = lists.flatten().dictionary_encode()
        code = words.indices.to_numpy()
        # every distinct word as its core and the marks that trail a letter
        core = pc.utf8_rtrim(words.dictionary, TAIL)
        core = pc.if_else(pc.match_substring_regex(core, PLAIN), core, words.dictionary)
        trailed = np.flatnonzero(pc.not_equal(core, words.dictionary).to_numpy(zero_copy_only=False))
        named = strings(words.dictionary.take(pa.array(trailed)))
        cut = pc.utf8_length(core.take(pa.array(trailed))).to_numpy(zero_copy_only=False).tolist()
        tail = np.zeros(len(core), np.int64)
        tail[trailed] = self._entries([w[k:] for w, k in zip(named, cut, strict=True)])
        bad = np.zeros(len(texts), bool)
        if not self.spaced:
            entry, row = self._entries(strings(core)), code
        else:
            line = pc.index(words.dictionary, "\n").as_py()
            fine = pc.match_substring_regex(words.dictionary, ENDS).to_numpy(zero_copy_only=False)
            if line >= 0:
                fine[line] = True
            ends = np.flatnonzero(code == line)
            first = np.zeros(len(code) + 1, bool)
            first[begin] = True
            bare = np.unique(np.concatenate([begin, ends, (ends + 1)[~first[ends + 1]]]).clip(0, len(code) - 1))
            odd = np.flatnonzero(~fine[code]) if not fine.all() else bare[:0]
            wrong = np.concatenate([odd, ends[first[ends] | first[ends + 1] | (ends + 1 == len(code))], ends[:-1][np.diff(ends) == 1]])
            bad[np.searchsorted(begin, wrong, "right") - 1] = True
            used = np.bincount(code, minlength=len(core))
            used -= np.bincount(code[bare], minlength=len(core))
            mid, (low, low_row) = np.flatnonzero(used), np.unique(code[bare], return_inverse=True)
            row = np.zeros(len(core), np.int64)
            row[mid] = np.arange(len(mid))
            row = row[code]
            row[bare] = len(mid) + low_row
            spaced = pc.binary_join_element_wise("", core.take(pa.array(mid)).cast(pa.string()), " ")
            entry = self._entries(strings(spaced) + strings(core.take(pa.array(low))))
            tail = np.concatenate([tail[mid], tail[low]])
        # the ids of every distinct word, then those of all words
        both = np.stack([entry, tail], 1)
        lens = self.size[both]
        flat, lens = gather(self.flat, self.first[both.ravel()], lens.ravel()), lens.sum(1)
        firsts = np.cumsum(lens) - lens
        if not bad.any():
            sizes = lens[row]
            ends_at = np.concatenate([[0], np.cumsum(sizes)])
            return gather(flat, firsts[row], sizes), ends_at[begin + per_text] - ends_at[begin]
        ids, total = [], np.zeros(len(texts), np.int64)  # a few texts are cut one by one
        for i in range(len(texts)):
            if bad[i]:
                x = self._chunk_ids(self._chunks(texts[i].as_py()))
            else:
                r = row[begin[i]:begin[i] + per_text[i]]
                x = gather(flat, firsts[r], lens[r])
            ids.append(x)
            total[i] = len(x)
        return np.concatenate(ids), total

    def _with_special(self, texts: pa.Array, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """encode(), with the special texts encoded whole."""
        plain, n = self.encode(texts.filter(pa.array(~special)))
        own = [np.array(self.whole(t), np.uint32) for t in texts.filter(pa.array(special)).to_pylist()]
        sizes = np.zeros(len(texts), np.int64)
        sizes[~special], sizes[special] = n, list(map(len, own))
        flat = np.concatenate([plain, *own])
        starts = np.zeros(len(texts), np.int64)
        starts[~special] = np.cumsum(n) - n
        starts[special] = len(plain) + np.cumsum(sizes[special]) - sizes[special]
        return gather(flat, starts, sizes), sizes


def strings(a: pa.Array) -> list[str]:
    """to_pylist(), but made in one C++ loop."""
    return a.to_numpy(zero_copy_only=False).tolist()


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs flat[s:s+n], one after the other."""
    ends = np.cumsum(lens)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    at = np.repeat(starts - (ends - lens), lens)
    at += np.arange(ends[-1])
    return flat[at]


def listed(ids: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array and the length of each."""
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens


class Batcher:
    """Encodes many chunks with few calls: plain ones stand in lines, between marks that are a pre-token of their own."""

    def __init__(self, encode: Callable[[list[str]], list], mark: str, per_line: int = 64):
        self.encode, self.mark, self.per_line = encode, mark, per_line
        ids = encode([mark])[0].ids
        self.mark_id = ids[0] if len(ids) == 1 else None

    def _plain(self, part: str) -> bool:
        """Visible ASCII characters or letters alone, behind at most one space, and no mark."""
        word = part[1:] if part[0] == " " else part
        return (word.isalpha() or (word.isascii() and word.isprintable() and " " not in word and bool(word))) and self.mark.strip(" ") not in word

    def __call__(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.mark_id is None or len(parts) < self.per_line:
            return listed([e.ids for e in self.encode(parts)])
        rest = [i for i, p in enumerate(parts) if not self._plain(p)]
        plain = np.ones(len(parts), bool)
        plain[rest] = False
        some = [p for p, ok in zip(parts, plain.tolist(), strict=True) if ok]
        lines = [self.mark.join([*some[i:i + self.per_line], ""]) for i in range(0, len(some), self.per_line)]
        flat, _ = listed([e.ids for e in self.encode(lines)])
        marks = flat == self.mark_id
        ends = np.flatnonzero(marks)
        if len(ends) != len(some):
            raise ValueError("a chunk gave the mark's own id")
        lens = np.zeros(len(parts), np.int64)
        lens[plain] = np.diff(ends, prepend=-1) - 1
        other, lens[rest] = listed([e.ids for e in self.encode([parts[i] for i in rest])])
        starts = np.zeros(len(parts), np.int64)
        starts[plain] = np.cumsum(lens[plain]) - lens[plain]
        flat = flat[~marks]
        starts[rest] = len(flat) + np.cumsum(lens[rest]) - lens[rest]
        return gather(np.concatenate([flat, other]), starts, lens), lens


_encoders: dict[tuple[str, bool], ChunkEncoder] = {}


def library_encoder(path: str, spaced: bool) -> ChunkEncoder:
    """One per Python worker: the tokenizers library on a vocabulary file, as it is loaded (an added token's content gives its id)."""
    if (path, spaced) not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        encode = Batcher(lambda xs: t.encode_batch_fast(xs, add_special_tokens=False), "\n" if spaced else " ~ ")
        added = [x.content for x in t.get_added_tokens_decoder().values()]
        _encoders[path, spaced] = ChunkEncoder(encode, spaced, added=added, whole=lambda x: t.encode(x, add_special_tokens=False).ids)
    return _encoders[path, spaced]


def slices(texts: pa.Array, most_bytes: int = 8_000_000):
    """(from, to) row ranges of at most about so many bytes, at least one row each."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if total and total + n > most_bytes:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(size):
        yield begin, len(size)
    pa.default_memory_pool().release_unused()  # else a worker keeps the most that a batch took
