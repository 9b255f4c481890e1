"""Pre-tokens of whole texts for vocabularies of words without white space.

Such a vocabulary lower-cases, drops white space and never joins what white space parts.
So texts are cut at ASCII white space, every different word of a chunk is split only
once, and counts and ids of texts are sums and concatenations over arrays.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the vocabulary format: the characters of words that plain expressions
# split exactly as the library does (visible ASCII and Latin letters), its split pattern
# over them after lower-casing, and the bytes that stand for themselves.
PLAIN = "^[!-~À-ÖØ-öø-įı-ɏ]*$"
SPLIT = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^\na-z0-9ß-öø-ɏ]+")
VISIBLE = (*range(33, 127), *range(161, 173), *range(174, 256))


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary."""
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in VISIBLE else chr(spare))
        spare += b not in VISIBLE
    return out


class Pretokenizer:
    """Splits words the way the library's normalizer and pre-tokenizer do."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        if self.spec["model"].get("end_of_word_suffix") is None:
            raise ValueError(f"{path}: only vocabularies with word ends and without white space are supported")
        self.library = Tokenizer.from_file(path)
        special = [t["content"] for t in self.spec["added_tokens"]]
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.opening = {t[:2] for t in special}
        self.symbols = byte_symbols()
        self.by_byte = {b: s for b, s in enumerate(self.symbols) if b != ord(" ")}

    def mapped(self, piece: str) -> str:
        return piece if piece.isascii() else "".join([self.symbols[b] for b in piece.encode()])

    def all_mapped(self, pieces: pa.Array) -> str:
        """The pieces in byte symbols, joined by one space."""
        one = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces.cast(pa.string()))
        text = pc.binary_join(one, " ")[0].as_py()
        return text if text.isascii() else text.encode().decode("latin-1").translate(self.by_byte)

    def odd_pieces(self, word: str) -> list[str | int]:
        """Pre-tokens of a word by the library; a special string is its id."""
        out: list[str | int] = []
        for part in self.at_special.split(word) if self.at_special else [word]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                plain = self.library.normalizer.normalize_str(part)
                out += [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]
        return out

    def cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, list[str | int]]:
        """Pre-tokens of all words in order: the word's number, the pre-token's code, and
        the different pre-tokens. First come those of plain words as they are, with the
        border "\n" that no word has, then those of the others, as `odd_pieces` gives them."""
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        for opening in self.opening:
            plain &= ~pc.match_substring(words, opening).to_numpy(zero_copy_only=False)
        simple = np.flatnonzero(plain)
        every = words.take(pa.array(simple)).cast(pa.string())
        one = pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every)
        joined = pc.binary_join(one, "\n")[0].as_py().lower() + "\n"
        coded = pa.array(SPLIT.findall(joined), pa.large_string()).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        border = codes == pc.index(coded.dictionary, "\n").as_py()
        owner = (np.cumsum(border) - border)[~border]
        owner, codes = (simple[owner] if len(simple) else owner[:0]), codes[~border]
        known: dict[str | int, int] = {}
        if len(simple) < len(words):
            odd = np.flatnonzero(~plain)
            own, more = [], []
            for i, word in zip(odd.tolist(), words.take(pa.array(odd)).to_pylist()):
                for p in self.odd_pieces(word):
                    own.append(i)
                    more.append(known.setdefault(p, len(known)))
            owner = np.concatenate((owner, np.array(own, np.int64)))
            codes = np.concatenate((codes, len(coded.dictionary) + np.array(more, np.int64)))
            order = np.argsort(owner, kind="stable")
            owner, codes = owner[order], codes[order]
        return owner, codes, coded.dictionary, list(known)

    def split(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str | int]]:
        """Pre-tokens of all words in order: the word's number, the pre-token's code, and
        the different pre-tokens in byte symbols, with ids in place of special strings."""
        owner, codes, plain, odd = self.cut(words)
        found: list[str | int] = [self.mapped(p) for p in plain.to_pylist()]
        if odd:
            known = {p: i for i, p in enumerate(found)}
            place = np.append(np.arange(len(found)), [known.setdefault(p, len(known)) for p in odd])
            found, codes = list(known), place[codes]
        return owner, codes, found


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[start:start + size] for each pair, one behind the other."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """First word of each text, a code for each word, and the different words by code."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0], coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
