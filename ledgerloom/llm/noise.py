"""Texts without a language, made for a network to learn what to reject.

Some kinds are drawn from nothing (base64, hex, mashed keys, junk tokens, code, repeats);
others undo a given text: its characters shuffled, or its letters replaced by those of some
alphabet, which leaves the words' shape but is a language that nobody speaks.
"""

from __future__ import annotations

import base64
import random

LETTERS = "abcdefghijklmnopqrstuvwxyz"
ROWS = ("qwertyuiop", "asdfghjkl;", "zxcvbnm,./")
ALPHABETS = (LETTERS, LETTERS, "".join(map(chr, range(0xE0, 0x180))), *("".join(map(chr, range(*r))) for r in (
    (0x3B1, 0x3CA), (0x430, 0x450), (0x561, 0x587), (0x5D0, 0x5EB), (0x627, 0x64B), (0x905, 0x93A), (0xE01, 0xE2F), (0x10D0, 0x10F1), (0x3041, 0x3097), (0x4E00, 0x5600), (0xAC00, 0xB400))))
KEYWORDS = "if else for while return def class import from const let var function public static void int string null true false self this new try catch lambda select where in not and or".split()
MARKS = "(){}[];:,.=+-*/<>!&|\"'_#"


def _token(rnd: random.Random, alphabet: str, low: int, high: int) -> str:
    return "".join(rnd.choices(alphabet, k=rnd.randint(low, high)))


def _base64(rnd, text):
    return rnd.choice(("", "", "data:", "id=")) + base64.b64encode(rnd.randbytes(256)).decode()


def _hex(rnd, text):
    digits, gap, run = rnd.choice(("0123456789abcdef", "0123456789ABCDEF")), rnd.choice(("", " ", "-", ":", "\n")), rnd.choice((2, 4, 8, 16, 32, 64))
    return gap.join(_token(rnd, digits, run, run) for _ in range(1 + 256 // (run + 1)))


def _mash(rnd, text):
    out = []
    while sum(map(len, out)) < 300:
        out.append(_token(rnd, rnd.choice((*ROWS, LETTERS, ROWS[1][:4], ROWS[1][5:])), 2, 14))
        out.append(rnd.choice(("", " ", " ")))
    return "".join(out)


def _junk(rnd, text):
    kinds = (LETTERS + "0123456789", LETTERS.upper() + LETTERS + "0123456789", "bcdfghjklmnpqrstvwxz", LETTERS, LETTERS.upper(), LETTERS + "@#$%^&*~_|")
    one = rnd.choice((kinds, (rnd.choice(kinds),)))
    return rnd.choice((" ", " ", "_", ", ")).join(_token(rnd, rnd.choice(one), 1, rnd.choice((4, 8, 16))) for _ in range(90))


def _code(rnd, text):
    names = [_token(rnd, LETTERS, 1, 5) + rnd.choice(("", "", "_" + _token(rnd, LETTERS, 1, 6), str(rnd.randrange(99)))) for _ in range(8)]
    out = []
    while sum(map(len, out)) < 300:
        out.append(rnd.choice((rnd.choice(KEYWORDS) + " ", rnd.choice(names), rnd.choice(names), f" {rnd.choice('=+-<>*')} ", "".join(rnd.choices(MARKS, k=rnd.randint(1, 3))), f"({rnd.choice(names)})", str(rnd.randrange(1000)), rnd.choice((";\n    ", "\n", " {\n  ", "}\n")))))
    return "".join(out)


def _repeat(rnd, text):
    return (_token(rnd, rnd.choice((LETTERS, LETTERS.upper(), LETTERS + "0123456789", rnd.choice(ALPHABETS))), 1, 5) + rnd.choice(("", " "))) * 256


def _shuffled(rnd, text):
    kept = rnd.random() < 0.5  # the gaps between words
    text = text or _token(rnd, LETTERS, 8, 64)
    chars = [c for c in text if not (kept and c.isspace())]
    rnd.shuffle(chars)
    at = iter(chars)
    return "".join(c if kept and c.isspace() else next(at) for c in text)


def _cipher(rnd, text):
    text = text or _token(rnd, LETTERS, 8, 64)
    own = sorted({c for c in text.lower() if c.isalpha()})
    alphabet = rnd.choice(ALPHABETS)
    code = dict(zip(own, rnd.sample(alphabet, len(own)) if len(own) <= len(alphabet) else rnd.choices(alphabet, k=len(own))))
    return "".join(code.get(c.lower(), c) for c in text)


KINDS = (_base64, _hex, _mash, _junk, _code, _repeat, _shuffled, _shuffled, _cipher, _cipher)


def noise(rnd: random.Random, text: str, size: int) -> bytes:
    """At most ``size`` bytes of one kind, from a place that is not always the beginning."""
    raw = rnd.choice(KINDS)(rnd, text).encode()
    at = rnd.randint(0, max(0, min(40, len(raw) - size)))
    return raw[at:at + size]
