"""Token ids of whole texts from a public tokenizer file, inside tasks.

All ids come from the tokenizers library. Texts repeat words, so a block of
texts is cut into words with Arrow, each distinct word is encoded once and
kept, and numpy puts the ids of a text together. Texts are cut only where the
tokenizer's own pre-tokenisation always cuts: at single spaces and line ends
between characters that are no white space (byte-level file), or at spaces
and line ends (word file, which drops white space). A text in which another
kind or run of white space occurs (byte-level file), or the string of one of
the file's added tokens ("<|endoftext|>" is one id), goes through the library
whole. Tests compare both ways. The tables are bounded and start anew when full.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS_KEPT = 250_000  # about 200 bytes each, in every worker process
CHUNK = 256
BLOCK_CHARS = 4_000_000

_MARK = "\x02"
# Texts that the byte-level cut leaves whole: the mark itself, white space
# other than space and line end, runs of white space, white space at an end.
_ODD = ("[\x02\t\x0b\x0c\r\x1c-\x1f\x85\u00a0\u1680\u2000-\u200f\u2028\u2029\u202f\u205f\u3000]"
        "|[ \n][ \n]|^[ \n]|[ \n]\\z")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# Pieces that can be encoded side by side in one call.
_BYTE_PLAIN = re.compile(f" [{_LETTERS}]+")
_WORD_PLAIN = re.compile(f"[{_LETTERS}]+")
# Signs behind a letter and before white space or the end are a piece: both
# files' pre-tokenisation cuts between letters and signs.
_SIGNS = r"(\p{L})([!-/:-@\[-`{-~]+)([ \n]|\z)"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """ids(texts) -> one bytes of little-endian unsigned 32-bit ids a text."""

    def __init__(self, path: str, kind: str, words_kept: int = WORDS_KEPT):
        self.words_kept = words_kept
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # a text with the string of an added token is left whole: it is one id
        added = "|".join(re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values())
        self.odd = "|".join(x for x in (_ODD if kind == "byte" else "", added) if x)
        self.byte = kind == "byte"
        self.words: dict[str, bytes] = {}
        # ids that begin a piece with a space, or end a word
        self.edge = np.zeros(self.tok.get_vocab_size() + 1, dtype=bool)
        for token, i in self.tok.get_vocab().items():
            self.edge[i] = token.startswith("\u0120") if self.byte else token.endswith("</w>")
    def _learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces, by the library."""
        plain = (_BYTE_PLAIN if self.byte else _WORD_PLAIN).fullmatch
        side: list[int] = []
        alone: list[int] = []
        for k, p in enumerate(pieces):
            (side if plain(p) else alone).append(k)
        out: list[bytes] = [b""] * len(pieces)
        join = "" if self.byte else " "
        for at in range(0, len(side), CHUNK):
            group = side[at:at + CHUNK]
            e = self.tok.encode(join.join([pieces[k] for k in group]), add_special_tokens=False)
            ids = np.array(e.ids, dtype="<u4")
            edge = np.flatnonzero(self.edge[ids])
            if len(edge) != len(group):  # a word that the library cuts itself
                alone += group
                continue
            cut = [*(4 * edge).tolist(), 4 * len(ids)] if self.byte else [0, *(4 * edge + 4).tolist()]
            raw = ids.tobytes()
            for k, a, b in zip(group, cut, cut[1:]):
                out[k] = raw[a:b]
        for k, e in zip(alone, self.tok.encode_batch([pieces[k] for k in alone], add_special_tokens=False)):
            out[k] = np.array(e.ids, dtype="<u4").tobytes()
        return out

    def _look_up(self, words: list[str]) -> list[bytes]:
        found = list(map(self.words.get, words))
        new = [k for k, x in enumerate(found) if x is None]
        if new:
            if len(self.words) > self.words_kept:
                self.words.clear()
            unknown = [words[k] for k in new]
            learned = self._learn(unknown)
            self.words.update(zip(unknown, learned))
            for k, x in zip(new, learned):
                found[k] = x
        return found

    def _block(self, texts: pa.Array) -> list[bytes]:
        odd = np.zeros(len(texts), dtype=bool)
        if self.odd:
            odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        if self.byte:
            plain = pc.replace_substring_regex(texts, _SIGNS, rf"\1{_MARK}\2\3")
            plain = pc.replace_substring(plain, " ", _MARK + " ")
            plain = pc.replace_substring(plain, "\n", f"{_MARK}\n{_MARK}")
            lists = pc.split_pattern(plain, _MARK)
        else:
            plain = pc.replace_substring_regex(texts, _SIGNS, r"\1 \2\3")
            lists = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        if odd.any():
            lists = pc.if_else(pa.array(odd), pa.scalar([], lists.type), lists)
        coded = pc.dictionary_encode(lists.flatten())
        ids = self._look_up(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        word = coded.indices.to_numpy(zero_copy_only=False)
        n = size[word]
        end = np.cumsum(n)
        source = np.repeat((np.cumsum(size) - size)[word] - (end - n), n) + np.arange(end[-1] if len(end) else 0)
        out = flat[source]
        bounds = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(
            pc.list_value_length(lists).to_numpy(zero_copy_only=False))])].tolist()
        made = [out[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
        if odd.any():
            at = np.flatnonzero(odd).tolist()
            whole = self.tok.encode_batch([texts[k].as_py() for k in at], add_special_tokens=False)
            for k, e in zip(at, whole):
                made[k] = np.array(e.ids, dtype="<u4").tobytes()
        return made

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        block: list[str] = []
        chars = 0
        for t in texts:
            block.append(t)
            chars += len(t)
            if chars > BLOCK_CHARS:
                out += self._block(pa.array(block, pa.string()))
                block, chars = [], 0
        return out + (self._block(pa.array(block, pa.string())) if block else [])


_ENCODERS: dict[tuple[str, str, int], Encoder] = {}


def encoder(path: str, kind: str, words_kept: int = WORDS_KEPT) -> Encoder:
    """One encoder per worker process, file and table size."""
    key = (path, kind, words_kept)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
