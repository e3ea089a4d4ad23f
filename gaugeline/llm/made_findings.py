"""Labelled findings made for training: secrets and harmless long tokens of many kinds,
put between the words of real documents.

A corpus labels few of its secrets, and all of one kind or two. The kinds here stand for
what services publish about the look of their keys (a prefix, an alphabet, a length) and
for the ordinary tokens that look most like them. Each is drawn anew, with words of its
own document, in one of the surroundings that both labels share, so that neither a
certain string nor what stands around it tells the label."""

from __future__ import annotations

import random
import re
import string

_LOWER, _UPPER, _DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
_MIXED = string.ascii_letters + _DIGITS
_WORDS = re.compile("[A-Za-z]{3,10}")
_SPARE = ["data", "part", "item", "report", "train", "image"]
#: Characters of a document around the place of a made finding.
NEAR = 300


def _of(rng, letters: str, least: int, most: int) -> str:
    return "".join(rng.choice(letters) for _ in range(rng.randint(least, most)))


def _letters(rng) -> str:
    """An alphabet that is itself drawn: numerals of a base above 16, digits and a few
    letters of either case, or any part of letters and digits."""
    form = rng.randint(0, 2)
    if form == 0:
        return _DIGITS + rng.choice([_LOWER, _UPPER])[: rng.randint(8, 26)]
    if form == 1:
        return _DIGITS + "".join(rng.sample(rng.choice([_LOWER, _UPPER, string.ascii_letters]), rng.randint(5, 12)))
    pool = rng.choice([_LOWER + _DIGITS, _UPPER + _DIGITS, _MIXED])
    return "".join(rng.sample(pool, rng.randint(12, len(pool)))) + _of(rng, _DIGITS, 2, 4)


def _prefixed(rng, words):
    head = _of(rng, _LOWER, 2, 4) + rng.choice(["_", "-", "_live_", "_test_", "-api03-", "_pat_"])
    return head + _of(rng, rng.choice([_MIXED, _letters(rng)]), 20, 44)


def _base64(rng, words):
    size = 4 * rng.randint(6, 22)
    fill = rng.choice(["", "", "=", "=="])
    return _of(rng, _MIXED + "+/", size - len(fill), size - len(fill)) + fill


def _web_token(rng, words):
    return "eyJ" + _of(rng, _MIXED + "_-", 24, 160)


def _mixed(rng, words):
    return _of(rng, _MIXED, 18, 64)


def _upper_hex(rng, words):
    size = rng.choice([24, 32, 40, 64])
    return _of(rng, "ABCDEF" + _DIGITS, size, size)


def _base32(rng, words):
    return _of(rng, _UPPER + "234567", 20, 52)


def _lower(rng, words):
    return _of(rng, _LOWER + _DIGITS, 20, 48)


def _groups(rng, words):
    letters, size = rng.choice([_UPPER, _LOWER, _MIXED]) + _DIGITS, rng.randint(4, 6)
    return "-".join(_of(rng, letters, size, size) for _ in range(rng.randint(4, 6)))


def _alphabet(rng, words):
    token = _of(rng, _letters(rng), 18, 64)
    if rng.random() < 0.3:
        size, mark = rng.randint(5, 12), rng.choice("-_+/")
        token = mark.join(token[i : i + size] for i in range(0, len(token), size))
    return token


def _slug(rng, words):
    parts = [rng.choice(words) for _ in range(rng.randint(3, 7))]
    parts.insert(rng.randint(0, len(parts)), rng.choice([_of(rng, _DIGITS, 1, 5), f"v{rng.randint(1, 20)}", "2024", f"part{rng.randint(1, 99)}"]))
    return rng.choice("-_").join(rng.choice([p.lower(), p, p.capitalize()]) for p in parts)


def _path(rng, words):
    parts = [rng.choice(words).lower() for _ in range(rng.randint(3, 6))]
    last = [f"part-{rng.randint(0, 99999):05d}", _of(rng, "abcdef" + _DIGITS, 7, 10), f"{rng.randint(1990, 2030)}/{rng.randint(1, 12):02d}", f"v{rng.randint(1, 9)}"]
    return "/".join([*parts, rng.choice(last)])


def _identifier(rng, words):
    parts = [rng.choice(words).capitalize() for _ in range(rng.randint(3, 5))]
    parts.insert(rng.randint(1, len(parts)), str(rng.randint(1, 2048)))
    name = "".join(parts)
    return rng.choice([name, name[0].lower() + name[1:]])


def _constant(rng, words):
    return "_".join([rng.choice(words).upper() for _ in range(rng.randint(3, 5))] + [str(rng.randint(0, 4096))])


def _book(rng, words):
    return rng.choice(["ISBN", "isbn", "EAN"]) + rng.choice("-=") + "-".join(_of(rng, _DIGITS, n, n) for n in (3, 1, 2, 6, 1))


def _number(rng, words):
    head = rng.choice([rng.choice(words).upper()[:5], "SKU", "IMG", "REF", "ORDER"])
    return head + rng.choice("-_") + rng.choice("-_").join(_of(rng, _DIGITS, 4, 8) for _ in range(rng.randint(2, 3)))


def _time(rng, words):
    date = f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}T"
    return rng.choice(words).lower() + "-" + date + rng.choice(["10-22-33Z", "102233Z", f"{rng.randint(10, 23)}-{rng.randint(10, 59)}-00"])


def _package(rng, words):
    return "lib" + rng.choice(words).lower() + f"{rng.randint(1, 9)}-" + rng.choice(words).lower() + f"_{rng.randint(1, 30)}-{rng.randint(0, 9)}_" + rng.choice(["amd64", "arm64", "x86_64", "all"])


SECRETS = {
    "prefixed": _prefixed, "base64": _base64, "web_token": _web_token, "mixed": _mixed,
    "upper_hex": _upper_hex, "base32": _base32, "lower": _lower, "groups": _groups, "alphabet": _alphabet,
}
HARMLESS = {
    "slug": _slug, "path": _path, "identifier": _identifier, "constant": _constant,
    "book": _book, "number": _number, "time": _time, "package": _package,
}
KINDS = (*SECRETS, *HARMLESS)

#: What stands around a made token, its own place as {}.
SURROUNDINGS = ["{}"] * 6 + ['"{}"', "'{}'", "({})", "{},", "{}.", "key = {}", 'auth: "{}"', "id={}", "value: {}", "https://www.example.com/?ref={}", "| {} |"]


def made(text: str, seed: int, kinds: tuple[str, ...] = KINDS) -> list[tuple[int, str, str, int, int]]:
    """(label, kind, text around, start, end) of one secret and one harmless token drawn
    for a document, of ``kinds``."""
    rng = random.Random(seed)
    found = []
    for label, shapes in ((1, SECRETS), (0, HARMLESS)):
        kind = rng.choice(list(shapes))
        around = rng.choice(SURROUNDINGS)
        at = rng.randint(0, len(text))
        before, after = text[max(0, at - NEAR) : at], text[at : at + NEAR]
        before, after = before[: before.rfind(" ") + 1], after[after.find(" ") :] if " " in after else ""
        token = shapes[kind](rng, _WORDS.findall(before + after) or _SPARE)
        if kind in kinds:
            head, tail = around.split("{}")
            start = len(before) + len(head)
            found.append((label, kind, before + head + token + tail + after, start, start + len(token)))
    return found
