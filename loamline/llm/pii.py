"""Format-preserving pseudonyms for personal data.

Numbers and dates that validate (card numbers by their check digit, dates by the calendar, addresses
by their ranges, ...) are replaced by others of the same format: the value is mapped to a number
below the size of its format, a keyed Feistel network permutes the numbers, and the result is
written in the same format with the same separators. Values that leave the format's range are
permuted again (cycle walking), so every format has a bijection: equal values get equal pseudonyms in all
documents, different ones different pseudonyms, and the key's owner can invert them.

Texts are changed row by row; nothing is shuffled.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from loamline.llm.tables import slices

ROUNDS = 8
KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date", "secret")


class Feistel:
    """A keyed permutation of the numbers below ``size``."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.seed = hashlib.blake2b(f"{tweak}|{size}".encode(), key=key, digest_size=32).digest()

    def _round(self, i: int, x: int) -> int:
        width = self.half // 8 + 1
        got = hashlib.blake2b(x.to_bytes(width, "big"), key=self.seed, salt=bytes([i]) * 8, digest_size=min(64, width + 8))
        return int.from_bytes(got.digest(), "big") & self.mask

    def _once(self, x: int, rounds) -> int:
        left, right = x >> self.half, x & self.mask
        for i in rounds:
            left, right = right, left ^ self._round(i, right)
        return right << self.half | left

    def forward(self, x: int) -> int:
        x = self._once(x, range(ROUNDS))
        while x >= self.size:
            x = self._once(x, range(ROUNDS))
        return x

    def inverse(self, x: int) -> int:
        x = self._once(x, range(ROUNDS - 1, -1, -1))
        while x >= self.size:
            x = self._once(x, range(ROUNDS - 1, -1, -1))
        return x


@lru_cache(maxsize=4_096)
def _network(key: bytes, tweak: str, size: int) -> Feistel:
    return Feistel(key, tweak, size)


_HEX, _DIGITS, _LETTERS = "0123456789abcdef", "0123456789", "abcdefghijklmnopqrstuvwxyz"


# Symbols that are permuted as one number. Longer values are permuted in stretches, each under what lies before it.
STRETCH = 128


def permute_text(key: bytes, tweak: str, text: str, hexadecimal: bool = False, back: bool = False) -> str:
    """Letters become letters of the same case and digits digits; other characters stay."""
    if len(text) <= STRETCH:
        return _permute_stretch(key, tweak, text, hexadecimal, back)
    out, before = [], b""
    for at in range(0, len(text), STRETCH):
        part = text[at : at + STRETCH]
        own = f"{tweak}:{before.hex()}" if at else tweak
        out.append(_permute_stretch(key, own, part, hexadecimal, back))
        plain = (out[-1] if back else part).lower()
        before = hashlib.blake2b(before + plain.encode(), digest_size=16).digest()
    moved = "".join(out)
    # Only a value that is all of one case is written in one; a stretch of digits has none.
    return moved.upper() if hexadecimal and text.isupper() else moved


def _permute_stretch(key: bytes, tweak: str, text: str, hexadecimal: bool, back: bool) -> str:
    places = [i for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    sets = [_HEX if hexadecimal else _DIGITS if text[i].isdigit() else _LETTERS for i in places]
    value, size = 0, 1
    for i, chars in zip(places, sets):
        value = value * len(chars) + chars.index(text[i].lower())
        size *= len(chars)
    if not places:
        return text
    shape = "".join("h" if s is _HEX else "9" if s is _DIGITS else "a" for s in sets)
    network = _network(key, f"{tweak}:{shape}", size)
    value = network.inverse(value) if back else network.forward(value)
    out = list(text)
    for i, chars in zip(reversed(places), reversed(sets)):
        value, k = divmod(value, len(chars))
        out[i] = chars[k].upper() if text[i].isupper() else chars[k]
    if hexadecimal and text.isupper():
        return "".join(out).upper()
    return "".join(out)


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    source = iter(digits)
    return "".join(next(source) if c.isdigit() else c for c in pattern)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _walk(step: Callable[[str], str], valid: Callable[[str], bool], value: str) -> str:
    """Cycle walking over texts: permutes until the result is valid."""
    value = step(value)
    while not valid(value):
        value = step(value)
    return value


def _email(key, text, back):
    local, _, domain = text.rpartition("@")
    labels = domain.split(".")
    cut = max(0, len(labels) - 2)
    inner = ".".join(labels[:cut])
    moved = permute_text(key, "email", f"{local}@{inner}", back=back)
    local, _, inner = moved.rpartition("@")
    return f"{local}@{'.'.join([*([inner] if inner else []), *labels[cut:]])}"


def _valid_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1


def _card(key, text, back):
    digits = re.sub(r"\D", "", text)
    body = digits[0] + permute_text(key, "card" + digits[0], digits[1:-1], back=back)
    check = next(c for c in _DIGITS if luhn(body + c))
    return _refill(text, body + check)


def _iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in (body + country + "00").upper())
    return f"{98 - int(number) % 97:02d}"


def _iban(key, text, back):
    bare = text.replace(" ", "")
    country, check, body = bare[:2], bare[2:4], bare[4:]
    if not 15 <= len(bare) <= 34 or _iban_check(country, body) != check:
        return None
    body = permute_text(key, "iban" + country, body, back=back)
    source = iter(country + _iban_check(country, body) + body)
    return "".join(c if c == " " else next(source) for c in text)


def _valid_ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _ssn(key, text, back):
    digits = re.sub(r"\D", "", text)
    return _refill(text, _walk(lambda d: permute_text(key, "ssn", d, back=back), _valid_ssn, digits))


def _phone_parts(text: str) -> tuple[str, str, str] | None:
    """Country, the rest and its digits; None if no phone has as many."""
    country = re.match(r"\+\d{1,3}(?=\D)", text)
    head = country.group() if country else "+" if text[0] == "+" else ""
    rest = text[len(head) :]
    digits = re.sub(r"\D", "", rest)
    return (head, rest, digits) if 7 <= len(digits) <= 15 else None


def _phone(key, text, back):
    head, rest, digits = _phone_parts(text)
    return head + _refill(rest, permute_text(key, "phone" + head, digits, back=back))


def _valid_ip(text: str) -> bool:
    return not any(int(o) > 255 or len(o) > 1 and o[0] == "0" for o in text.split("."))


def _ip(key, text, back):
    octets = text.split(".")
    network = _network(key, "ip", 1 << 32)
    value = int.from_bytes(bytes(map(int, octets)), "big")
    value = network.inverse(value) if back else network.forward(value)
    return ".".join(map(str, value.to_bytes(4, "big")))


_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _date(key, text, back):
    parts = re.split(r"([-/.])", text)
    a, sep, b, again, c = parts
    if sep != again:
        return None
    # Year first; else day first, unless only month first gives a date.
    orders = (("y", "m", "d"),) if len(a) == 4 else (("d", "m", "y"), ("m", "d", "y"))
    for order in orders:
        got = dict(zip(order, map(int, (a, b, c))))
        try:
            day = dt.date(got["y"], got["m"], got["d"]).toordinal()
        except ValueError:
            continue
        if not _FIRST_DAY <= day <= _LAST_DAY:
            return None
        network = _network(key, "date" + "".join(order), _LAST_DAY - _FIRST_DAY + 1)
        move = network.inverse if back else network.forward
        # A date that reads day first must stay one of its own reading.
        day = move(day - _FIRST_DAY)
        while order[0] == "m" and dt.date.fromordinal(day + _FIRST_DAY).day <= 12:
            day = move(day)
        new = dt.date.fromordinal(day + _FIRST_DAY)
        return sep.join(f"{ {'y': new.year, 'm': new.month, 'd': new.day}[k]:0{4 if k == 'y' else 2}d}" for k in order)
    return None


def _secret(key, text, back):
    for prefix in ("eyJ", "AKIA", "ASIA", "ghp_", "gho_", "sk-", "xoxb-", "xoxp-"):
        if text.startswith(prefix):
            return prefix + permute_text(key, "secret" + prefix, text[len(prefix) :], back=back)
    named = _NAMED.fullmatch(text)
    if named:
        value = named.group(2)
        plain_hex = re.fullmatch("[0-9a-f]+|[0-9A-F]+", value) is not None
        return named.group(1) + permute_text(key, "hex" if plain_hex else "named", value, plain_hex, back)
    return permute_text(key, "hex", text, hexadecimal=True, back=back)


_NAME = r"(?i:\b(?:password|passwd|pwd|(?:aws[_-])?secret[_-]access[_-]key|client[_-]secret|secret|(?:auth[_-]|access[_-])?token|api[_-]?key)\s?[=:]\s?[\"']?)"
_NAMED = re.compile(rf"({_NAME})([A-Za-z0-9_+/-]+)")
_PATTERN = re.compile(
    r"(?P<email>(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,126}\.[A-Za-z]{2,63}\b)"
    rf"|(?P<secret>{_NAME}(?=[A-Za-z_+/-]*\d)[A-Za-z0-9_+/-]{{8,}}"
    r"|\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?![A-Za-z0-9_-])"
    r"|\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:ghp_|gho_|sk-|xoxb-|xoxp-)[A-Za-z0-9-]{16,}\b"
    r"|(?<![0-9A-Za-z])(?=[0-9a-fA-F]*\d)(?=[0-9a-fA-F]*[a-fA-F])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z]))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)"
)
# Kinds made of digit groups, each matched at the start of a group.
_FIXED = (
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)")),
    ("date", re.compile(
        r"(?<![\d./-])(?:\d{4}(?:-\d{2}-\d{2}|/\d{2}/\d{2}|\.\d{2}\.\d{2})"
        r"|\d{1,2}(?:-\d{1,2}-|/\d{1,2}/|\.\d{1,2}\.)\d{4})(?![\d/-]|\.\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", re.compile(r"(?<![\d.+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])")),
)
_AREA = re.compile(r"(?<![\w+])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)")
_WORLD = re.compile(r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}")
_ZONE = re.compile(r"\+?\(?\d+(?:[ .()/+-]{1,3}\d+)*")
_GROUP = re.compile(r"\d+")
_CARD_SHAPES = ((4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4), (4, 3, 3, 3), (6, 13))
_SHAPED = 10  # what a value in a usual format is worth, in digits
_CHANGE = {
    "email": _email, "card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date, "secret": _secret,
}
# Whether a text in a kind's format is a value of it.
_CHECK = {
    "ip": _valid_ip, "date": lambda text: _date(b"", text, False) is not None,
    "ssn": lambda text: _valid_ssn(text.replace("-", "")), "phone": lambda text: True,
}
_WORTH = re.compile(r"[0-9@]")


def _candidates(text: str, groups: list[tuple[int, int]], i: int):
    """(kind, start, end, in a usual format) of the valid values that begin with digit group ``i``."""
    start = groups[i][0]
    before = text[start - 1 : start]
    for kind, pattern in _FIXED:
        match = pattern.match(text, start)
        if match and _CHECK[kind](match.group()):
            yield kind, start, match.end(), True
    if before == "(" and (match := _AREA.match(text, start - 1)):
        yield "phone", start - 1, match.end(), True
    if before == "+":
        digits = 0
        for first, end in groups[i:]:
            digits += end - first
            if digits > 18:
                return
            if _WORLD.fullmatch(text, start - 1, end) and _phone_parts(text[start - 1 : end]):
                yield "phone", start - 1, end, True
        return
    joined = lambda k: 0 < k < len(groups) and text[groups[k - 1][1] : groups[k][0]] in (" ", "-")
    digits = ""
    for j in range(i, len(groups)):
        if j > i and not joined(j):
            return
        digits += text[slice(*groups[j])]
        if len(digits) > 19:
            return
        # Of a longer run of small numbers, such as a table's row, every second part would do by chance.
        whole = not joined(i) and not joined(j + 1)
        if (whole or len(digits) >= 3 * (j + 1 - i)) and _valid_card(digits):
            shape = tuple(e - s for s, e in groups[i : j + 1])
            yield "card", start, groups[j][1], len(shape) == 1 or shape in _CARD_SHAPES


def _numbers(text: str, start: int, stop: int) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the values made of digit groups.

    Neighbouring numbers may read as one value or as several; of all ways to cut a row of groups the
    one that covers most digits by valid values wins, and usual formats count more.
    """
    found = []
    for zone in _ZONE.finditer(text, start, stop):
        if zone.end() - zone.start() < 7:  # the shortest value is an address of four digits
            continue
        groups = [m.span() for m in _GROUP.finditer(text, *zone.span())]
        after = {end: j + 1 for j, (_, end) in enumerate(groups)}
        best, take = [0] * (len(groups) + 1), [None] * len(groups)
        for i in reversed(range(len(groups))):
            best[i] = best[i + 1]
            for kind, s, e, usual in _candidates(text, groups, i):
                j = after.get(e)
                if j is None or s < zone.start():
                    continue
                worth = sum(b - a for a, b in groups[i:j]) + _SHAPED * usual + best[j]
                if worth > best[i]:
                    best[i], take[i] = worth, (kind, s, e)
        i = 0
        while i < len(groups):
            if take[i]:
                found.append(take[i])
                i = after[take[i][2]]
            else:
                i += 1
    return found


def pseudonymise(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind were replaced."""
    if not text or not _WORTH.search(text) and not any(p in text for p in ("AKIA", "eyJ")):
        return text, {}
    counts: dict[str, int] = {}
    out: list[str] = []
    done = at = 0

    def put(kind: str, start: int, end: int, new: str) -> None:
        nonlocal done
        out.extend((text[done:start], new))
        counts[kind] = counts.get(kind, 0) + 1
        done = end

    def numbers(stop: int) -> None:
        for kind, start, end in _numbers(text, done, stop):
            put(kind, start, end, _CHANGE[kind](key, text[start:end], back))

    while match := _PATTERN.search(text, at):
        start, end, kind = match.start(), match.end(), match.lastgroup
        new = _CHANGE[kind](key, match.group(), back)
        while new is None and (end := text.rfind(" ", start, end)) > start:  # an IBAN with what follows it
            new = _CHANGE[kind](key, text[start:end], back)
        if new is None:
            at = start + 1
            continue
        numbers(start)
        put(kind, start, end, new)
        at = end
    numbers(len(text))
    return "".join(out) + text[done:], counts


def replace_personal_data(
    docs: DataFrame,
    key: bytes,
    id_col: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    counted: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: id, the columns ``keep``, text with pseudonyms and, if ``counted``,
    n_replaced and n_<kind> for each kind.

    Null and empty texts stay as they are, with counts of 0; repeated rows repeat; an empty table
    gives no rows. The key is 16 to 64 secret bytes; whoever holds it can invert the pseudonyms.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key needs 16 to 64 bytes")
    plain = docs.select(docs[text], docs[id_col], *[docs[c] for c in keep])
    others = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[1:])
    extra = ["n_replaced", *[f"n_{k}" for k in KINDS]] if counted else []
    schema = ", ".join([others, f"`{text}` string", *[f"{c} int" for c in extra]])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 500):
                done = [pseudonymise(t, key) for t in part.column(0).to_pylist()]
                columns = [*part.columns[1:], pa.array([t for t, _ in done], pa.string())]
                if counted:
                    numbers = [[sum(c.values()) for _, c in done], *[[c.get(k, 0) for _, c in done] for k in KINDS]]
                    columns += [pa.array(n, pa.int32()) for n in numbers]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[1:], text, *extra])

    return plain.mapInArrow(run, schema)
