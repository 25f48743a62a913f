"""Token ids by the public word-level BPE vocabulary, with each distinct chunk of text encoded once per worker; and token
counts by the public byte-level one."""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from .common import CACHE_BYTES, ENTRY, LONG_KEY, Cache, model

#: Characters handled at a time, which bounds a worker's memory.
AT_ONCE = 1 << 20
#: These count as white space for str.split but not for the tokenizer.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordBpe:
    """ids of texts as little-endian 32-bit bytes.

    The vocabulary's pieces never cross white space and each piece ends with exactly one word-end token, so a text's
    ids are those of its white-space chunks in order, and chunks can be encoded together and told apart again.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, normalizers

        self.bare = Tokenizer.from_file(path)
        self.bare.encode_special_tokens = True
        self.bare.normalizer = normalizers.Sequence([])  # chunks come normalised
        vocabulary = self.bare.get_vocab()
        self.ends = np.zeros(len(vocabulary) + 1, bool)
        for word, i in vocabulary.items():
            self.ends[i] = word.endswith("</w>")
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.known = Cache(self._alone, 2 * CACHE_BYTES)

    def _alone(self, chunk: str) -> bytes:
        return np.array(self.bare.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, text: str) -> str:
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        return (text.replace("Σ", "σ") if "Σ" in text else text).lower()  # letter by letter, as the tokenizer does

    def _learn(self, pieces: list[str]) -> None:
        """ids of single pieces, each of which ends with the only word-end token among its ids."""
        ids = np.array(self.bare.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        at = [0, *(4 * np.flatnonzero(self.ends[ids]) + 4).tolist()]
        if len(at) == len(pieces) + 1 and at[-1] == 4 * len(ids):
            raw = ids.tobytes()
            self.known.update(zip(pieces, [raw[i:j] for i, j in zip(at, at[1:])]))
        else:
            self.known.update((p, self._alone(p)) for p in pieces)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= AT_ONCE):
                size += len(texts[stop])
                stop += 1
            out += self._some(texts[start:stop])
            start = stop
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if known.room < 0:
            known.clear()
        chunks = [[self._plain(t)] if any(c in t for c in SEPARATORS) else self._plain(t).split() for t in texts]
        made: dict[str, list[str]] = {}
        new: dict[str, None] = {}
        for w in set().union(*chunks).difference(known):
            if w.isalpha():
                new[w] = None
            elif w[-1] in ".,;:!?" and w[:-1].isalpha():
                made[w] = [w[:-1], w[-1]]
                new.update(dict.fromkeys(p for p in made[w] if p not in known))
            else:
                made[w] = self.pieces.findall(w)
                new.update(dict.fromkeys(p for p in made[w] if p not in known))
        fresh = list(new)
        for i in range(0, len(fresh), 4096):
            self._learn(fresh[i : i + 4096])
        known.update((w, b"".join([known[p] for p in ps])) for w, ps in made.items())
        out = [b"".join([known[w] for w in c]) for c in chunks]
        known.room -= ENTRY * (len(new) + len(made))
        for words in (new, made):  # long chunks are not kept
            for w in [w for w in words if len(w) > LONG_KEY]:
                known.pop(w, None)
        return out


@model
def encoder(path: str) -> WordBpe:
    return WordBpe(path)


@model
def byte_encoder(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def byte_counts(texts: list[str]) -> list[int]:
    """How many tokens of the public byte-level vocabulary each text has; special strings are ordinary text."""
    import public_tokenizers

    own = byte_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return [len(own.encode_ordinary(t)) for t in texts]
