"""Charsets of pages that name none, chosen by how likely their letters stand beside each other."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np

#: Single-byte charsets that are told apart, in the order that counts where a body is as likely in several.
CHARSETS = ("cp1254", "iso-8859-9", "cp1252", "iso-8859-1")

#: Letters beyond ASCII of the languages that the charsets are for, by how often they occur among such letters (per cent).
LETTERS = {
    "tr": {"ı": 36, "ş": 13, "ü": 14, "ğ": 8, "ç": 9, "ö": 6, "İ": 5, "Ş": 2, "Ü": 1, "Ö": 2, "Ç": 2, "â": 1, "î": 0.5, "û": 0.5},
    "west": {"é": 25, "ä": 10, "ü": 10, "ö": 6, "è": 7, "á": 6, "ó": 6, "í": 5, "à": 6, "ñ": 3, "ß": 4, "ê": 4, "ç": 3, "ú": 2, "É": 1, "Ä": 0.5, "Ö": 0.5, "Ü": 0.5, "î": 1, "ô": 1.5, "û": 1, "â": 1, "ã": 1, "õ": 0.5, "ï": 0.5, "å": 1, "ø": 1, "æ": 1, "ý": 0.2, "ð": 0.1, "þ": 0.1},
}
#: Signs beyond ASCII that texts hold, and their share beside letters (per cent).
SIGNS = {"’": 4, "“": 2, "”": 2, "–": 3, "—": 1, "…": 1, "€": 2, "«": 1, "»": 1, "°": 1, "·": 1, " ": 3, "©": 1, "®": 0.5, "‘": 1, "„": 1, "•": 1, "™": 0.5, "¿": 0.5, "¡": 0.5, "²": 0.3, "½": 0.3}

_LANGUAGE = {"cp1254": "tr", "iso-8859-9": "tr", "cp1252": "west", "iso-8859-1": "west"}
_HIGH = re.compile(rb"[\x80-\xff]")


def _kinds(chars: Iterable[str]) -> np.ndarray:
    """Of each byte's character: 0 blank or mark, 1 small letter, 2 capital, 3 none or a control."""
    return np.array([3 if c is None or not (c.isprintable() or c in "\t\n\r ") else 1 if c.islower() else 2 if c.isupper() else 0 for c in chars], np.int64)


class Pairs:
    """Log-likelihood of each pair of bytes of which one is beyond ASCII, for a charset and its language's letters.

    A character counts by its share among letters or signs, a rare one by a small share, one that the charset doesn't have or that controls by a
    hundredth of that; and by its neighbour: letters stand beside letters, small ones after any and before small ones, capitals
    at the beginning of words or among capitals.
    """

    RARE, NONE = 1e-4, 1e-7
    #: How likely a character of a kind follows one of a kind, relative to each other: rows before, columns after.
    BESIDE = np.array([[1.0, 0.7, 1.0, 0.1], [0.8, 1.0, 0.05, 0.1], [0.5, 0.9, 0.7, 0.1], [0.1, 0.1, 0.1, 0.1]])

    def __init__(self, charset: str):
        chars = []
        for b in range(256):
            try:
                chars.append(bytes([b]).decode(charset))
            except UnicodeDecodeError:
                chars.append(None)
        share = LETTERS[_LANGUAGE[charset]] | SIGNS
        kinds = _kinds(chars)
        of = np.array([1.0 if b < 128 else share.get(c, 100 * self.RARE) / 100 for b, c in enumerate(chars)])
        of[(kinds == 3) & (np.arange(256) >= 128)] = self.NONE
        self.log = np.log(of)[None, :] + np.log(self.BESIDE[kinds[:, None], kinds[None, :]])
        self.log[:128, :128] = 0

    def of(self, pairs: np.ndarray, counts: np.ndarray) -> float:
        return float((self.log.ravel()[pairs] * counts).sum())


_MODELS = {name: Pairs(name) for name in CHARSETS}


def guess(body: bytes) -> str:
    """The charset that a body fits best: UTF-8 if it can be read so, else the likeliest of CHARSETS by all pairs of its bytes.

    A body that breaks off within a character of UTF-8, or holds a wrong byte in 1,000, still counts as UTF-8.
    """
    try:
        body.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        pass
    read = body.decode("utf-8", "ignore")
    high = len(_HIGH.findall(body))
    wrong = len(body) - len(read.encode("utf-8"))
    if high - wrong >= max(2, 9 * wrong):
        return "utf-8"
    data = np.frombuffer(b" " + body + b" ", np.uint8).astype(np.int64)
    pairs, counts = np.unique(data[:-1] * 256 + data[1:], return_counts=True)
    some = (pairs >= 128 * 256) | (pairs % 256 >= 128)
    score = {name: model.of(pairs[some], counts[some]) for name, model in _MODELS.items()}
    return max(CHARSETS, key=lambda name: score[name])
