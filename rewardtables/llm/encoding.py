"""Token ids of whole texts by the tokenizers library, word by word.

The tokenizer drops white space and none of its rules looks across it, so the ids of a
text are the ids of its words between ASCII white space, one after the other. Words of
printable ASCII and Latin letters are cut further into the pieces that the tokenizer's own
pattern gives; the library encodes many pieces at once, and an id that ends a word ends
a piece. All other words go to the unchanged tokenizer. ``tests/llm/test_encoding.py``
compares with whole texts. Each worker keeps the ids of words and pieces that it has seen
in tables of bounded size.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

CACHED = 600_000
CACHED_BYTES = 40
BATCH = 2_000

# fixed value: the word pattern of the public vocabulary file
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts with the tokenizer of a file; ids as unsigned 32-bit numbers."""

    _open: dict[str, WordEncoder] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        self._whole.no_truncation()
        self._whole.no_padding()
        self._pieces = Tokenizer.from_file(path)
        self._pieces.no_truncation()
        self._pieces.no_padding()
        self._pieces.normalizer = normalizers.Sequence([])
        self._pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self._whole.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._cut = regex.compile(PIECES).findall
        # no white space, no control characters, no special-token marks
        self._plain = regex.compile(r"(?!.*<\|)[!-~À-ɏ]+").fullmatch
        self._words: dict[bytes, bytes] = {}
        self._known: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """The worker's encoder for this file."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _piece_ids(self, pieces: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        for at in range(0, len(pieces), BATCH):
            part = pieces[at : at + BATCH]
            ids = np.asarray(
                self._pieces.encode(" ".join(part), add_special_tokens=False).ids, dtype="<u4"
            )
            stops = (np.flatnonzero(self._ends[ids]) + 1).tolist()
            if len(stops) != len(part):  # a vocabulary without ends of words
                stops, ids = [], np.empty(0, dtype="<u4")
                for piece in part:
                    code = self._pieces.encode(piece, add_special_tokens=False).ids
                    ids = np.concatenate([ids, np.asarray(code, dtype="<u4")])
                    stops.append(len(ids))
            raw, start = ids.tobytes(), 0
            for piece, stop in zip(part, stops, strict=True):
                found[piece] = raw[4 * start : 4 * stop]
                start = stop
        return found

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new words."""
        cut: dict[bytes, list[str]] = {}
        odd: list[bytes] = []
        plain, pieces, known = self._plain, self._cut, self._known
        for word in words:
            if len(word) > CACHED_BYTES:
                odd.append(word)
            elif word.isalpha():  # ASCII letters only
                cut[word] = [word.lower().decode()]
            elif plain(text := word.decode()):
                cut[word] = pieces(unicodedata.normalize("NFC", text).lower())
            else:
                odd.append(word)
        new = {p for parts in cut.values() for p in parts if p not in known}
        fresh = self._piece_ids(list(new))
        found = {
            w: b"".join([known[p] if p in known else fresh[p] for p in parts])
            for w, parts in cut.items()
        }
        if len(known) < CACHED:
            known.update(fresh)
        for at in range(0, len(odd), BATCH):
            part = odd[at : at + BATCH]
            coded = self._whole.encode_batch_fast(
                [w.decode() for w in part], add_special_tokens=False
            )
            for word, code in zip(part, coded, strict=True):
                found[word] = np.asarray(code.ids, dtype="<u4").tobytes()
        return found

    def encode_many(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of whole texts, each with the end id behind it."""
        tail = end.to_bytes(4, "little")
        cut = [t.encode("utf-8", "replace").split() for t in texts]
        known = self._words
        fresh = self._learn([w for w in set().union(*cut) if w not in known])
        out = [
            b"".join([known[w] if w in known else fresh[w] for w in words]) + tail
            for words in cut
        ]
        if len(known) < CACHED:
            known.update((w, i) for w, i in fresh.items() if len(w) <= CACHED_BYTES)
        return [np.frombuffer(ids, dtype="<u4") for ids in out]
