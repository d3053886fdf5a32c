"""BPE encoding and decoding by a tokenization automaton compiled from the merges.

The automaton reads tokens: its arcs bear token labels, and a path from the start spells the one tokenization that the
merges give to the path's text. It begins as one state with an arc to itself for every base symbol. Each merge (u, v), in
order of rank, is one gadget:

- the state q that u leads to is copied without its arc v, and u leads to the copy from now on: v can no longer follow u;
- every state with an arc u gets an arc uv, to where v leads from q: the merged pair goes on as v would.

Every arc of one label leads to one state, so that state is named by the label, and a copy holds only what it lost and
when (`lost`). State x has arc t unless some state it is copied from, before that copy was made, lost t, or lost a left
part of t no later than the merge that needed it (`arc`). Arcs are decided once and kept in a transition table.

Encoding runs over a word's symbols: from the state at a position, the longest token that starts there and has an arc is
taken first, a shorter one if that leads nowhere. The tokenization of each prefix is unique, so a position is entered from
one place only, and time is linear in the word's length. Decoding emits the arcs' labels.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from feedlake.llm.rows import BoundedCache, kept, map_texts
from feedlake.llm.token_counts import byte_alphabet

BITS = 20  # of a label or trie node number
#: Arcs kept in the transition table before it is emptied, and pieces whose ids are kept.
TABLE, PIECES = 400_000, 500_000

# Characters whose normal form, lower case and class this Python and the library's tables agree on (tested one by one);
# texts with others are normalized and cut by the library itself. U+001C to U+001F are white space to str.split alone.
_ELSEWHERE = re.compile("[^\x00-\x1b\x20-՗Ḁ-ỿ‐-⁤　-〩ぁ-ゖ゠-ヺ一-鿿가-힣]")


class MergeAutomaton:
    """Compiles a tokenizer file (JSON) of BPE with an end-of-word suffix, byte-level after splitting by a pattern."""

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(data)
        model, cut, norm = spec["model"], spec["pre_tokenizer"], spec["normalizer"]
        steps = [p["type"] for p in cut.get("pretokenizers", [])]
        kinds = [n["type"] for n in (norm or {}).get("normalizers", [])]
        if model["type"] != "BPE" or steps != ["Split", "ByteLevel"] or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("a BPE model with NFC, white space and lower-case normalizers, a pattern and byte level is needed")
        library = Tokenizer.from_str(data.decode())
        self.normalize, self.pre_tokenize = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.find = regex.compile(cut["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.to_byte = byte_alphabet()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.added = added
        self.labels = {i: t for t, i in (model["vocab"] | added).items()}
        self.decimals = [str(i) for i in range(max(self.labels) + 1)]
        self.compile(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.table: dict[int, bool] = {}
        self.pieces = BoundedCache(self.encode_piece, limit=PIECES)

    def compile(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        #: symbols of a label: bytes, and 256 + the byte at the end of a word
        spelled: dict[int, tuple[int, ...]] = {}
        for char, byte in self.to_byte.items():
            for text, symbol in ((char, byte), (char + suffix, 256 + byte)):
                if text in vocab:
                    spelled[vocab[text]] = (symbol,)
        #: `left` and `right`: a label's spine of left (right) parts, each with the merge that took the part up
        never = len(merges)
        self.left = {t: ((t, never),) for t in spelled}
        self.right = {t: ((t, never),) for t in spelled}
        self.lost: dict[int, int] = {}  # (label the state follows, arc) -> merge whose gadget removed the arc
        for k, m in enumerate(merges):
            a, b = m.split(" ") if isinstance(m, str) else m
            u, v, t = vocab[a], vocab[b], vocab[a + b]
            if t in spelled or u not in spelled or v not in spelled:
                raise ValueError(f"merge {k} makes a token again or uses one not made yet")
            spelled[t] = spelled[u] + spelled[v]
            self.lost[u << BITS | v] = k
            # t has its left part's arcs' fate up to k, and leads to a copy of where its right part leads at k
            self.left[t] = ((t, never),) + ((u, k),) + self.left[u][1:]
            self.right[t] = ((t, never),) + ((v, k),) + self.right[v][1:]
        self.trie: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for t, symbols in spelled.items():
            node = 0
            for s in symbols:
                at = node << 9 | s
                node = self.trie.get(at)
                if node is None:
                    node = self.trie[at] = len(self.ends)
                    self.ends.append(-1)
            self.ends[node] = t

    def arc(self, x: int, t: int) -> bool:
        """Whether the state that label x leads to has an arc t."""
        lost = self.lost.get
        for part, needed in self.left[t]:
            for state, copied in self.right[x]:
                k = lost(state << BITS | part)
                if k is not None and k < copied and k <= needed:
                    return False
        return True

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        symbols, n = list(word), len(word)
        symbols[-1] += 256
        table, next_node, ends = self.table, self.trie.get, self.ends
        ids: list[int] = []
        open_arcs: list[list[tuple[int, int]]] = []  # of each position on the path: (label, where it ends), longest last
        i, x = 0, -1
        while True:
            arcs, node = [], 0
            for p in range(i, n):
                node = next_node(node << 9 | symbols[p])
                if node is None:
                    break
                t = ends[node]
                if t >= 0:
                    arcs.append((t, p + 1))
            while True:
                while arcs:
                    t, at = arcs.pop()
                    if x < 0:
                        break  # the start state has lost no arc
                    key = x << BITS | t
                    ok = table.get(key)
                    if ok is None:
                        if len(table) >= TABLE:
                            table.clear()
                        ok = table[key] = self.arc(x, t)
                    if ok:
                        break
                else:  # no arc leads on: back to the position before
                    arcs = open_arcs.pop()
                    ids.pop()
                    x = ids[-1] if ids else -1
                    continue
                break
            ids.append(t)
            if at == n:
                return tuple(ids)
            open_arcs.append(arcs)
            i, x = at, t

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a lower-cased piece without white space. Letters alone are one word, by the pattern."""
        if piece.isalpha():
            return self.encode_word(piece.encode())
        words = self.find(piece)
        if len(words) == 1:
            return self.encode_word(piece.encode())
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, words)))

    def encode_plain(self, text: str) -> list[int]:
        """Ids of a text without special strings."""
        if _ELSEWHERE.search(text):
            cut = self.pre_tokenize(self.normalize(text))
            to_byte = self.to_byte
            return list(chain.from_iterable(self.encode_word(bytes(map(to_byte.__getitem__, w))) for w, _ in cut))
        if not text.isascii():
            # the library lower-cases each character alone: no final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return list(chain.from_iterable(map(self.pieces.__getitem__, text.lower().split())))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.special is None or not self.special.search(text):
            return self.encode_plain(text)
        ids: list[int] = []
        for k, part in enumerate(self.special.split(text)):
            ids += [self.added[part]] if k % 2 else self.encode_plain(part) if part else []
        return ids

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined by spaces as the library does without a decoder; unknown ids have none."""
        try:
            return " ".join(map(self.labels.__getitem__, ids))
        except KeyError:
            return " ".join(self.labels[i] for i in ids if i in self.labels)


def _broadcast(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_words(docs: DataFrame, vocabulary_path: str, keep=("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns and ids array<int>.

    Null and empty texts, and texts of white space alone, have no ids (an empty array). Repeated rows, null keys and
    extra columns pass as they are; an empty table gives no rows. No shuffle: each row is encoded where it is read. The
    vocabulary file (1 to 2 MB, whatever the data) is read by the driver and broadcast.
    """
    shared = _broadcast(docs, vocabulary_path)

    def make():
        encode = kept(shared, MergeAutomaton).encode
        return lambda texts: ([encode(t) for t in texts],)

    return map_texts(docs, list(keep), text, make, [StructField("ids", ArrayType(IntegerType(), False))], keeps=True)


def decode_words(df: DataFrame, vocabulary_path: str, keep=("doc_id",), ids: str = "ids") -> DataFrame:
    """`keep` columns and `decoded`, the text of each row's ids; null and empty ids decode to the empty text."""
    shared = _broadcast(df, vocabulary_path)

    def make():
        decode = kept(shared, MergeAutomaton).decode
        return lambda rows: ([decode(x or []) for x in rows],)

    return map_texts(df, list(keep), ids, make, [StructField("decoded", StringType())], keeps=True)


def round_trip_digests(docs: DataFrame, vocabulary_path: str, keep=("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns, n_tokens, ids_sha256 (decimal ids joined by spaces) and decoded_sha256 (the ids' decoded text).

    Rows as in `encode_words`; the ids are decoded where they are made and only digests leave the task.
    """
    shared = _broadcast(docs, vocabulary_path)

    def make():
        automaton = kept(shared, MergeAutomaton)

        decimals = automaton.decimals.__getitem__

        def run(texts):
            out = ([], [], [])
            for t in texts:
                ids = automaton.encode(t)
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(" ".join(map(decimals, ids)).encode()).hexdigest())
                out[2].append(hashlib.sha256(automaton.decode(ids).encode()).hexdigest())
            return out

        return run

    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return map_texts(docs, list(keep), text, make, fields, keeps=True)
