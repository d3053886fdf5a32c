"""Cutting texts for byte-level BPE: the public pattern, and a cheaper cut at spaces that never crosses a match."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from feedlake.llm.rows import BoundedCache

#: Fixed value: the public byte-level BPE pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

pretokens = regex.compile(PATTERN).findall

#: A white-space character before a space. Without one, every space follows a visible character (or starts the text),
#: and a match of the pattern always ends there: no alternative runs from a visible character into white space.
_spaces_run = re.compile(r"\s ").search


def chunks(text: str) -> list[str] | None:
    """Pieces between spaces, to be tokenized apart (each but the first with its space in front); None if the text
    has white-space runs that a cut at spaces could split."""
    return None if _spaces_run(text) else text.split(" ")


_word_start = re.compile(r"[^\W\d_]+").match


def letters(piece: str) -> str:
    """The letters a piece begins with, which are one match of the pattern; none if other word characters are among them."""
    found = _word_start(piece)
    return found[0] if found and found[0].isalpha() else ""


#: `_spaces_run` for Arrow: the characters that Python's \s takes, written out, and a space.
SPACES_RUN = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "


class KeptIds:
    """Words and their ids as two Arrow columns: some 40 bytes a word, where a dict's entry with its two objects takes 200.
    When they are too many, words that were not asked for since the last such time go."""

    def __init__(self):
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.asked = np.empty(0, bool)

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each of some distinct words, -1 for those that are not kept."""
        # the hash table is made of the fewer words
        found = pc.index_in(self.words, value_set=words)
        places = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        self.asked[places] = True
        at = np.full(len(words), -1, np.int64)
        at[found.drop_null().to_numpy()] = places
        return at

    def add(self, words: pa.Array, ids: pa.Array, limit: int) -> None:
        """Keeps distinct words that are not kept yet: `limit` of them at most, beside as many that were asked for."""
        words, ids = words.slice(0, limit), ids.slice(0, limit)
        if len(self.words) + len(words) > 2 * limit:
            stay = pa.array(np.flatnonzero(self.asked)[-limit:])
            self.words, self.ids, self.asked = self.words.take(stay), self.ids.take(stay), np.zeros(len(stay), bool)
        self.words, self.ids = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.ids, ids])
        self.asked = np.append(self.asked, np.ones(len(words), bool))


class PieceIds:
    """Ids of texts by their pieces between spaces, each distinct piece of a column asked for once and kept a while.

    `of_matches` encodes a list of matches of the pattern, each to its 32-bit ids as bytes; `whole` encodes a text that a cut
    could split (white-space runs, a string of `added`), and with its space each piece that `refused` picks from a list. Of kept
    pieces at most about twice `limit` lie in Arrow columns; long ones are not kept.
    """

    def __init__(
        self,
        of_matches: Callable[[list[str]], list[bytes]],
        whole: Callable[[str], bytes],
        refused: Callable[[list[str]], set[str]] = lambda pieces: set(),
        added: Sequence[str] = (),
        limit: int = 150_000,
        few: int = 50_000,
        longest: int = 48,
    ):
        self.of_matches, self.whole, self.refused, self.added = of_matches, whole, refused, added
        self.limit, self.longest, self.kept = limit, longest, KeptIds()
        self.matches = BoundedCache(lambda m: of_matches([m])[0], limit=few)
        self.tails = BoundedCache(self.joined, limit=few)

    def joined(self, text: str) -> bytes:
        return b"".join(map(self.matches.__getitem__, pretokens(text)))

    def of_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces with a space in front. Letters at a piece's start are one match with the space; what
        follows them is cut alike without them. Only the letters, and refused pieces, are kept whole."""
        odd = self.refused(pieces)
        heads = [p if p.isalpha() or p in odd else letters(p) for p in pieces]
        words = [h for h in dict.fromkeys(heads) if h]
        known = dict(zip(words, self.of_words(words, odd)))
        tails = self.tails
        return [
            tails[" " + p] if not h else known[h] if h is p else known[h] + tails[p[len(h) :]] for p, h in zip(pieces, heads)
        ]

    def of_words(self, words: list[str], odd: set[str]) -> list[bytes]:
        kept = self.kept
        column = pa.array(words, pa.large_string())
        at = kept.find(column)
        new = np.flatnonzero(at < 0).tolist()
        ids = kept.ids.take(pa.array(at, mask=at < 0)).to_numpy(zero_copy_only=False).tolist()
        made = iter(self.of_matches([" " + words[i] for i in new if words[i] not in odd]))
        for i in new:
            ids[i] = self.whole(" " + words[i]) if words[i] in odd else next(made)
        short = [i for i in new if len(words[i]) <= self.longest]
        kept.add(column.take(pa.array(short, pa.int64())), pa.array([ids[i] for i in short], pa.large_binary()), self.limit)
        return ids

    def of_first(self, piece: str) -> bytes:
        return self.whole(piece) if self.refused([piece]) else self.joined(piece)

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the place where each text's ids begin, with the end of the last.

        Arrow cuts the texts at spaces and numbers their distinct pieces. Null and empty texts have no ids.
        """
        texts = pc.fill_null(texts, "")
        uncut = pc.match_substring_regex(texts, SPACES_RUN)
        for string in self.added:
            uncut = pc.or_(uncut, pc.match_substring(texts, string))
        cut = pc.split_pattern(pc.if_else(uncut, "", texts), " ")
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(), dtype=np.int64)
        pieces, begins = cut.flatten(), np.append(0, ends)[:-1]
        later = np.ones(len(pieces), bool)
        later[begins] = False
        coded = pieces.filter(pa.array(later)).dictionary_encode()
        ids = self.of_pieces(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = np.empty(len(pieces), np.int64)
        at[later] = coded.indices.to_numpy()
        at[begins] = np.arange(len(ids), len(ids) + len(texts))
        heads = pieces.take(pa.array(begins)).to_numpy(zero_copy_only=False).tolist()
        for i, (text_uncut, head) in enumerate(zip(uncut.to_numpy(zero_copy_only=False).tolist(), heads)):
            ids.append(self.whole(texts[i].as_py()) if text_uncut else self.of_first(head))
        made = pa.array(ids, pa.large_binary()).take(pa.array(at))
        offsets = np.frombuffer(made.buffers()[1], np.int64, len(at) + 1)
        return np.frombuffer(made.buffers()[2] or b"", np.uint32, offsets[-1] // 4), offsets[np.append(0, ends)] // 4
