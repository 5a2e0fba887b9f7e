"""Token ids of the public byte-level vocabulary, and spans of tokens in characters."""

from __future__ import annotations

import base64

import numpy as np

from tapeloom.llm.common import per_process, ship

ship(__name__)

VOCABULARY = "byte_bpe_50k"
END = 2


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes ordinary text by the rank file, which gives the ids of the ``tokenizers`` file several times as fast.

    Texts in which a special token is spelled out go through ``tokenizers`` itself, so that ids
    are always those of ``Tokenizer.encode(text, add_special_tokens=False)``.
    """

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._exact = Tokenizer.from_file(json_path)
        self._special = [t.content for t in self._exact.get_added_tokens_decoder().values()]
        self.n_bytes = np.zeros(max(ranks.values()) + 2, np.int64)
        for token, i in ranks.items():
            self.n_bytes[i] = len(token)
        for i, t in self._exact.get_added_tokens_decoder().items():
            self.n_bytes[i] = len(t.content.encode())

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self._special):
            return np.array(self._exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._fast.encode_ordinary(text), np.uint32)

    def char_spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end (exclusive) of each token; a token inside a character spans that character."""
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        of_byte = np.cumsum((raw & 0xC0) != 0x80) - 1
        end = np.cumsum(self.n_bytes[ids])
        start = end - self.n_bytes[ids]
        if not len(ids):
            return start, end
        return of_byte[start], of_byte[end - 1] + 1


def encoder(path=None) -> Encoder:
    """The worker's encoder. ``path``: gives a vocabulary file's place by its name."""

    def make():
        import public_tokenizers

        where = path or public_tokenizers.path
        return Encoder(where(f"{VOCABULARY}.json"), where(f"{VOCABULARY}.tiktoken"), public_tokenizers.PATTERN)

    return per_process(f"encoder-{VOCABULARY}", make)
