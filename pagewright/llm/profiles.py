"""Histograms of texts (character classes, letters, common words), language references, and their divergence."""

from __future__ import annotations

import numpy as np

# Frequent function words of the languages that occur, used to tell languages apart and prose from lists.
FUNCTION_WORDS = {
    "en": "the of and to in is was that for it on with as be at by this had not are but from or have an they which one were all there when up so if out no must should before after into than first then on once since because".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch wenn muss".split(),
    "fr": "le la les de des du et à en un une dans est que pour qui sur par plus pas au ce il sont avec son se ne aux mais était ou cette après avant sous a été d l n s c reste si".split(),
    "es": "el la los las de del y a en un una que es por con no para se al lo su como más o pero sus este entre está hasta sin sobre después antes si fue ha son era durante".split(),
}
LANGUAGES = tuple(FUNCTION_WORDS)

#: Character classes, in the order of the histogram.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "comma", "colon", "dash", "quote", "bracket", "bullet", "separator", "dot_run", "symbol", "control")


def _class_table() -> np.ndarray:
    """The class of each character of the basic plane; built by rule from Python's character properties."""
    t = np.full(0x10000, CLASSES.index("symbol"), np.uint8)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            k = "upper" if ch.isupper() else "lower"
        elif ch.isdigit():
            k = "digit"
        elif ch == "\n":
            k = "line"
        elif ch in "\t|;":
            k = "separator"
        elif ch.isspace():
            k = "space"
        elif c < 32 or 127 <= c < 160 or c == 0xFFFD:
            k = "control"
        elif ch in ".!?…":
            k = "stop"
        elif ch == ",":
            k = "comma"
        elif ch in ":/":
            k = "colon"
        elif ch in "-–—­¬":
            k = "dash"
        elif ch in "'\"’‘“”„«»":
            k = "quote"
        elif ch in "()[]{}<>":
            k = "bracket"
        elif ch in "•◦▪·*‣":
            k = "bullet"
        else:
            continue
        t[c] = CLASSES.index(k)
    return t


CLASS_OF = _class_table()


def codes(text: str) -> np.ndarray:
    """The code points of a text; those beyond the basic plane as U+FFFF."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF).astype(np.int64)


def histogram(owner: np.ndarray, kind: np.ndarray, owners: int, kinds: int) -> np.ndarray:
    """Counts by owner and kind; kinds below 0 are left out."""
    ok = kind >= 0
    return np.bincount(owner[ok] * kinds + kind[ok], minlength=owners * kinds).reshape(owners, kinds)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence to base 2) of each row of p from q; a row without counts is nan."""
    p = p.astype(float)
    total = p.sum(axis=-1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = p / total
        q = np.broadcast_to(q / q.sum(axis=-1, keepdims=True), p.shape)
        m = (p + q) / 2
        d = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1) + np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.where(total[..., 0] > 0, np.sqrt(np.maximum(d / 2, 0)), np.nan)
