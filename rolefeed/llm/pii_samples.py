"""Labelled text snippets to learn personal-data spans from, made by rule.

Each snippet is a list of parts ``(kind or None, text)``; kinds mark personal
data, None is other text, among it numbers that only look alike (failed check
digits, versions, dates, prices, order numbers, hexadecimal tokens).
"""
from __future__ import annotations

import random

WORDS = "the of and order item version page total see section about price table number ref code build from until".split()
CUES = {
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell"), "card": ("card", "visa", "paid", "credit"),
    "iban": ("iban", "account", "bank", "transfer"), "ssn": ("ssn", "social", "security"),
    "email": ("email", "mail", "write", "contact"), "ip": ("ip", "host", "address", "login")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    """ISO 13616: the rearranged number leaves 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def word(self) -> str:
        return self.r.choice(WORDS) if self.r.random() < 0.5 else "".join(self.r.choice("aeioutrnslm") for _ in range(self.r.randint(2, 9)))

    def grouped(self, digits: str) -> str:
        sep = self.r.choice(("", "", " ", "-"))
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))

    def personal(self, kind: str) -> str:
        r, d = self.r, self.digits
        if kind == "email":
            return f"{self.word()}{r.choice(('.', '_', ''))}{d(r.randint(0, 2))}{self.word()}@{self.word()}{d(r.randint(0, 1))}.{r.choice(('com', 'org', 'example.net'))}"
        if kind == "ip":
            return ".".join(str(r.randint(0, 255)) for _ in range(4))
        if kind == "card":
            body = r.choice("3456") + d(r.choice((14, 14, 14, 13)))
            return self.grouped(next(body + c for c in "0123456789" if luhn(body + c)))
        if kind == "phone":
            a, b, c = d(3), d(3), d(4)
            return r.choice((f"+1 ({a}) {b}-{c}", f"+{d(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{d(2)} {d(2)} {d(4)} {d(4)}"))
        if kind == "ssn":
            return f"{d(3)}-{d(2)}-{d(4)}"
        country, body = r.choice((("DE", 18), ("FR", 23), ("ES", 20), ("GB", 18), ("NL", 14)))
        bank = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(4)) if country in ("GB", "NL") else ""
        rest = bank + d(body - len(bank))
        text = next(f"{country}{n:02d}{rest}" for n in range(2, 99) if iban_ok(f"{country}{n:02d}{rest}"))
        return text if r.random() < 0.5 else " ".join(text[i:i + 4] for i in range(0, len(text), 4))

    def other(self) -> str:
        r, d = self.r, self.digits
        body = d(15)
        wrong = next(body + c for c in "0123456789" if not luhn(body + c))
        return r.choice((
            lambda: d(r.randint(1, 6)), lambda: f"{d(1)}.{d(1)}.{d(2)}", lambda: f"20{d(2)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}",
            lambda: f"{r.randint(1, 28)}.{r.randint(1, 12)}.20{d(2)}", lambda: f"{d(3)}.{d(2)}", lambda: f"{d(1)},{d(3)},{d(3)}", lambda: self.grouped(wrong),
            lambda: wrong, lambda: d(r.randint(7, 12)), lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice((8, 16, 40)))),
            lambda: "".join(r.choice("0123456789ABCDEF") for _ in range(25)), lambda: f"{r.randint(256, 999)}.{d(3)}.{d(3)}.{d(3)}",
            lambda: f"{d(2)}:{d(2)}:{d(2)}", lambda: f"{d(2)}-{d(3)}-{d(2)}", lambda: f"@{self.word()}", lambda: f"{d(4)}-{d(4)}", lambda: f"{d(3)}-{d(4)}"))()

    def snippet(self) -> list[tuple[str | None, str]]:
        r, out = self.r, []
        for _ in range(r.randint(1, 3)):
            out.append((None, " ".join(self.word() for _ in range(r.randint(1, 4))) + " "))
            if r.random() < 0.55:
                kind = r.choice(list(CUES))
                if r.random() < 0.5:
                    out.append((None, r.choice(CUES[kind]) + r.choice((" ", ": "))))
                out.append((kind, self.personal(kind)))
            else:
                out.append((None, self.other()))
            out.append((None, r.choice((" ", ", ", ". ", " "))))
        return out


def snippets(n: int, seed: int = 11) -> list[list[tuple[str | None, str]]]:
    make = Maker(seed)
    return [make.snippet() for _ in range(n)]
