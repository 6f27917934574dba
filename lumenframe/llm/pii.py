"""PII: surrogates that keep type, format, script and gender.

Each detected entity is replaced by a keyed permutation of the strings of its shape: digits become
digits, letters letters of the same class and case, check digits are made to fit as the original's do,
given names become names of the same gender and script. A permutation gives different entities different
surrogates and one entity one surrogate wherever it stands, with no table of entities. Entities are
taken in a normal form first (e-mail in lower case, telephone numbers as digits), so that spellings of
one entity correspond. Each permutation stays in its own strings: words that are no listed name walk on
past listed ones, secrets past those of hexadecimal digits, and what tells the kind of a number stays. So
no two entities of a kind share a surrogate, under any key; ``checked_key`` makes sure of it over all the
corpus's distinct entities, as written. A surname that a text gives with a title or a given name is
replaced wherever the text has it by itself, and keeps the ending that tells its gender.

Edge cases: null and empty texts stay as they are; texts of any length are searched whole; repeated
rows get equal texts; rows keep their other columns, but for one named ``_kinds``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, table, widened

KEY = "lumenframe-surrogates-1"

#: Given names by gender and script; a surrogate stays in its own list.
NAMES = {
    ("f", "latin"): "Anna Maria Laura Julia Sophie Emma Claire Lucia Elena Sarah Alice Helen Clara Marta Paula Irene Nora Eva Rosa Ines".split(),
    ("m", "latin"): "John Peter Paul Martin Thomas Daniel Lucas Pierre Jean Carlos Juan Miguel Hans Karl Max Felix Oscar Hugo Louis David".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Ирина Наталья Светлана Татьяна".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Михаил".split(),
}
#: Titles, with the gender that they tell.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Господин": "m", "Госпожа": "f"}
_LISTED = {n: (k, i) for k, names in NAMES.items() for i, n in enumerate(names)}

PATTERN = re.compile(
    r"""(?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-]))
    |(?P<awskey>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b)
    |(?P<secret>(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b\s*[=:]\s*["']?)(?P<value>[A-Za-z0-9_+/-]{8,}))
    |(?P<iban>\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)
    |(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d))
    |(?P<ipv6>(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]{0,34}::)(?:[0-9A-Fa-f]{0,4}:){2,7}(?:\d{1,3}(?:\.\d{1,3}){3}|[0-9A-Fa-f]{0,4}))(?![\w:]))
    |(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
    |(?P<card>(?<![\d-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4})(?![\d-]))
    |(?P<phone>(?<![\w+])(?:
        (?:\+|\b00[ ]?(?=[1-9]))(?:[17](?:[ ./()-]{0,3}\d){10}|[2-689]\d(?:[ ./()-]{0,3}\d){5,13})(?!\w)
        |0\d{1,4}[ ]?/[ ]?\d{3,8}(?:[ -]\d{2,4}){0,3}(?![\w-])
        |(?!\d\d(?P<d>[ .-])\d\d(?P=d)(?:19|20)\d\d(?!\d))0\d{1,4}(?P<by>[ .-])\d{2,8}(?:(?P=by)\d{2,4}){0,4}(?![\w-])
        |(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,5}\)[ .-]?\d{2,8}(?:[ .-]\d{2,4}){0,3}|\d{3}[ .-]\d{3}[ .-]\d{4}|(?<=\d[ .-])\d{2,4}(?:[ .-]\d{2,4}){2,4})(?![\w-])
        |1?[2-9]\d\d[2-9]\d{6}(?![\w-])))""",
    re.X,
)
TITLED = re.compile(rf"\b(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\.?[ ]+(?P<name>[^\W\d_a-zа-яё]\w+(?:[ ]+[^\W\d_a-zа-яё]\w+)?)")
_GIVEN = re.compile(rf"(?:{'|'.join(sorted(_LISTED, key=len, reverse=True))})\b")
#: Endings of Cyrillic surnames that differ by gender.
_ENDINGS = re.compile(r"(?<=[а-яё]{2})(?:ова|ева|ёва|ина|ына|ская|цкая|ов|ев|ёв|ин|ын|ский|цкий)\Z")
_SURNAME = re.compile(r"[ ]+[^\W\d_a-zа-яё]\w+")
#: Calling codes of one and of two digits; the others have three.
_CODES = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3}")
_KINDS = ("email", "awskey", "secret", "iban", "ip", "ipv6", "ssn", "card", "phone")
_TRIGGER = re.compile(r"[0-9@=:]")
_CLASSES = [*map(tuple, ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ"))]
_CLASS_OF = {c: (k, i) for k, letters in enumerate(_CLASSES) for i, c in enumerate(letters)}


class Permutation:
    """Keyed bijections of range(n) without fixed points: a walked Feistel network, and in it one step on."""

    def __init__(self, key: str):
        self.key = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def _round(self, tweak: str, r: int, x: int, bits: int) -> int:
        h = hashlib.blake2b(f"{tweak}|{r}|{x}".encode("utf-8", "surrogatepass"), key=self.key, digest_size=(bits + 7) // 8)
        return int.from_bytes(h.digest(), "big") & (1 << bits) - 1

    def _there(self, x: int, half: int, tweak: str, back: bool) -> int:
        a, b = x >> half, x & (1 << half) - 1
        for r in reversed(range(6)) if back else range(6):
            a, b = (b ^ self._round(tweak, r, a, half), a) if back else (b, a ^ self._round(tweak, r, b, half))
        return a << half | b

    def _walk(self, x: int, n: int, tweak: str, back: bool) -> int:
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        while True:
            x = self._there(x, half, tweak, back)
            if x < n:
                return x

    def __call__(self, x: int, n: int, tweak: str) -> int:
        """A cycle through all of range(n), so no x > 0 or 0 stays if n > 1."""
        if n < 2:
            return x
        return self._walk((self._walk(x, n, tweak, True) + 1) % n, n, tweak, False)


def permuted(p: Permutation, text: str, kind: str, sets: list[tuple[str, ...]] | None = None) -> str:
    """``text`` with each letter and digit moved within its class (or within ``sets``, one a character)."""
    number, size, shape, where = 0, 1, [], []
    for k, c in enumerate(text):
        letters = sets[k] if sets else _CLASSES[_CLASS_OF[c.lower()][0]] if c.lower() in _CLASS_OF else ()
        low = c if sets else c.lower()
        if low not in letters:
            shape.append(c)
            continue
        number, size = number * len(letters) + letters.index(low), size * len(letters)
        where.append((k, letters, c != low))
        shape.append("".join(letters[:2]))
    number = p(number, size, f"{kind}|{chr(0).join(shape)}")
    out = list(text)
    for k, letters, upper in reversed(where):
        number, at = divmod(number, len(letters))
        out[k] = letters[at].upper() if upper else letters[at]
    return "".join(out)


def luhn(digits: str) -> int:
    """The sum that is 0 modulo 10 for a valid number."""
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10


def _refill(text: str, new: str, is_slot=str.isalnum) -> str:
    it = iter(new)
    return "".join(next(it) if is_slot(c) else c for c in text)


def _digits(p: Permutation, digits: str, kind: str) -> str:
    """Digits; one that leads and is 2 to 9 stays so, and a 0 or 1 that leads stays."""
    ten = _CLASSES[0]
    return permuted(p, digits, kind, [ten if k else tuple("23456789") if d in "23456789" else (d,) for k, d in enumerate(digits)])


def _walked(p: Permutation, text: str, kind: str, others, sets: list[tuple[str, ...]] | None = None) -> str:
    """The next of ``text``'s cycle that isn't of ``others``: a permutation of the rest, as ``text`` is of it."""
    while others(text := permuted(p, text, kind, sets)):
        pass
    return text


def _phone(text: str) -> tuple[str, list[int]]:
    """What tells a telephone number's kind (+ and code, trunk 0 or nothing), and the places of its other digits."""
    at = [k for k, c in enumerate(text) if c.isdigit() and not (text[0] == "+" and text[k - 1 : k + 2] == "(0)")]
    digits = "".join(text[k] for k in at)
    lead = 0 if text[0] == "+" else 2
    if text[0] == "+" or digits.startswith("00"):
        code = _CODES.match(digits, lead)[0]
        return "" if code == "1" else f"+{code}", at[lead + len(code) :]
    if digits[0] == "0":
        return "0", at[1:]
    return "", at[len(digits) == 11 and digits[0] == "1" :]


def normal_form(kind: str, text: str) -> str:
    if kind == "email":
        return text.lower()
    if kind == "phone":
        lead, at = _phone(text)
        return lead + "".join(text[k] for k in at)
    if kind == "ipv6":
        ip = ipaddress.IPv6Address(text)
        return text.lower() if "." in text and not ip.ipv4_mapped else ip.compressed
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    return text


def surrogate(p: Permutation, kind: str, text: str) -> str:
    if kind == "email":
        local, domain = text.rsplit("@", 1)
        labels = domain.lower().split(".")
        own, rest = labels[:-2] or labels[:1], labels[-2:] if len(labels) > 2 else labels[1:]
        new = permuted(p, f"{local.lower()}@{'.'.join(own)}", f"email|{'.'.join(rest)}")
        new = "".join(c.upper() if k < len(local) and local[k].isupper() else c for k, c in enumerate(new))
        return ".".join([new, *(domain.split(".")[len(own) :])])
    if kind == "phone":
        _, at = _phone(text)
        out = list(text)
        for k, c in zip(at, _digits(p, "".join(text[k] for k in at), "phone")):
            out[k] = c
        return "".join(out)
    if kind == "card":
        d = normal_form(kind, text)
        body = d[0] + permuted(p, d[1:-1], f"card|{d[0]}|{luhn(d)}")
        last = next(c for c in "0123456789" if luhn(body + c) == luhn(d))
        return _refill(text, body + last, str.isdigit)
    if kind == "ssn":
        return _refill(text, _digits(p, normal_form(kind, text), "ssn"), str.isdigit)
    if kind == "ip":
        number, size, shape = 0, 1, []
        for o in text.split("."):
            low, n = {1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(o)]
            number, size = number * n + int(o) - low, size * n
            shape.append((low, n))
        number, out = p(number, size, f"ip|{shape}"), []
        for low, n in reversed(shape):
            number, k = divmod(number, n)
            out.append(str(low + k))
        return ".".join(reversed(out))
    if kind == "ipv6":
        if "." in text:
            head, tail = text.rsplit(":", 1)
            return f"{head}:{surrogate(p, 'ip', tail)}"
        if v4 := ipaddress.IPv6Address(text).ipv4_mapped:
            a, b, c, d = map(int, surrogate(p, "ip", str(v4)).split("."))
            new = f"{a << 8 | b:04x}:{c << 8 | d:04x}" if len(text) == 39 else f"{a << 8 | b:x}:{c << 8 | d:x}"
            new = ":".join([*text.split(":")[:-2], new])
            return new.upper() if text.upper() == text else new
        short = ipaddress.IPv6Address(text).compressed
        first = len(short) - len(short.lstrip("0123456789abcdef"))  # the kind of address stays
        # a group's first digit stays other than 0, a 0 alone stays
        sets = [(c,) if k < first or c == ":" or c == "0" and short[k - 1] == ":" else tuple("0123456789abcdef"[short[k - 1 : k] in (":", "") :]) for k, c in enumerate(short)]
        new = ipaddress.IPv6Address(_walked(p, short, "ipv6", lambda x: ipaddress.IPv6Address(x).ipv4_mapped, sets))
        new = new.exploded if len(text) == 39 else new.compressed
        return new.upper() if text.upper() == text else new
    if kind == "awskey":
        letters = tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        return text[:4] + permuted(p, text[4:], "awskey", [letters] * 16)
    if kind == "iban":
        own = normal_form(kind, text)
        body = permuted(p, own[4:], f"iban|{own[:2]}|{_iban_rest(own)}")
        check = next(f"{c:02d}" for c in range(2, 99) if _iban_rest(f"{own[:2]}{c:02d}{body}") == _iban_rest(own))
        return _refill(text, own[:2] + check + body)
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", text):
            return permuted(p, text, "hex", [tuple("0123456789abcdef")] * len(text))
        return _walked(p, text, "secret", re.compile(r"[0-9a-f]+").fullmatch)
    words = []
    for word in text.split(" "):
        if word in _LISTED:
            key, i = _LISTED[word]
            words.append(NAMES[key][p(i, len(NAMES[key]), f"name|{key}")])
        else:
            words.append(_surname(p, word))
    return " ".join(words)


def _ending(word: str) -> str:
    """What tells the gender of a surname, or nothing."""
    return m[0] if (m := _ENDINGS.search(word)) else ""


def _surname(p: Permutation, word: str) -> str:
    """Another word of its shape and, if it has one, with its ending; no listed name."""
    end = _ending(word)
    other = lambda x: x in _LISTED or _ending(x) != end
    if not end:
        return _walked(p, word, "surname", other)
    stem = word[: -len(end)]
    letters = [_CLASSES[_CLASS_OF[c.lower()][0]] if c.lower() in _CLASS_OF else (c,) for c in stem]
    sets = [tuple(x.upper() for x in s) if c.isupper() and len(s) > 1 else s for c, s in zip(stem, letters)]
    return _walked(p, word, f"surname|{end}", other, [*sets, *((c,) for c in end)])


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _is_ipv6(text: str) -> bool:
    """Whether it is an address, and no slice or scope such as 1::2."""
    groups = [g for g in text.split(":") if g]
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return any(c.isdigit() for c in text) and (len(groups) > 2 or "." in text or len(text.split(":")[0]) > 2)


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, text) of the entities of a whole text, in order, without overlaps."""
    found = []
    if _TRIGGER.search(text):
        for m in PATTERN.finditer(text):
            kind = next(k for k in _KINDS if m[k] is not None)
            start, end = m.span("value") if kind == "secret" else m.span()
            x = text[start:end]
            if kind == "iban" and (_iban_rest(normal_form(kind, x)) != 1 or not 2 <= int(x[2:4]) <= 98):
                continue
            if kind == "phone" and not (9 if x[0] == "0" else 7) <= sum(map(str.isdigit, x)) <= 15 + 2 * x.startswith("00"):
                continue
            if kind == "ipv6" and not _is_ipv6(x):
                continue
            found.append((start, end, kind, x))
    names = [(*m.span("name"), f"name|{TITLES[m['title']]}", m["name"]) for m in TITLED.finditer(text)] if any(t in text for t in TITLES) else []
    at, titled = 0, {k for a, b, *_ in names for k in range(a, b)}
    for m in _GIVEN.finditer(text):
        a, b = m.span()
        if a < at or a and (text[a - 1].isalnum() or text[a - 1] == "_") or a in titled:
            continue
        at = e.end() if (e := _SURNAME.match(text, b)) else b
        names.append((a, at, f"name|{_LISTED[m[0]][0][0]}", text[a:at]))
    if names:
        names += _mentions(text, names)
        taken, k, last = [(a, b) for a, b, *_ in found], 0, 0
        for x in sorted(names):
            while k < len(taken) and taken[k][1] <= x[0]:
                k += 1
            if (k == len(taken) or taken[k][0] >= x[1]) and x[0] >= last:
                found.append(x)
                last = x[1]
        found.sort()
    return found


def _mentions(text: str, names: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Where the unlisted words of the found names stand by themselves: they are the same persons."""
    words = {w: kind for *_, kind, x in names for w in x.split(" ") if len(w) > 2 and w not in _LISTED}
    if not words:
        return []
    # the longest first, at both ends of words; names are few, the text is read once
    each = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(words, key=lambda w: (-len(w), w))))})(?!\w)")
    at = {k for a, b, *_ in names for k in range(a, b)}
    return [(*m.span(), words[m[0]], m[0]) for m in each.finditer(text) if m.start() not in at]


def pseudonymise(p: Permutation, text: str) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds of what was replaced, in order."""
    out, at, kinds = [], 0, []
    for start, end, kind, x in entities(text):
        out += [text[at:start], surrogate(p, kind, x)]
        at = end
        kinds.append(kind.split("|")[0])
    return "".join(out) + text[at:] if kinds else text, kinds


def _distinct(docs: DataFrame) -> DataFrame:
    """(kind, entity) of all rows, as written, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted({(k, x) for t in batch.column(0).to_pylist() if t for _, _, k, x in entities(t)})
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["kind", "entity"])

    return docs.select("text").mapInArrow(run, "kind string, entity string").distinct()


def collisions(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Emitted surrogates, in normal form, that several distinct entities of the corpus share: (kind, surrogate, n)."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permutation(key)
        for batch in batches:
            rows = [(k.split("|")[0], normal_form(k, x), normal_form(k, surrogate(p, k, x))) for k, x in zip(batch.column("kind").to_pylist(), batch.column("entity").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["kind", "entity", "surrogate"])

    made = _distinct(docs).mapInArrow(run, "kind string, entity string, surrogate string").distinct()
    return made.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def checked_key(docs: DataFrame, key: str = KEY) -> str:
    """``key``, once no two entities of the corpus share a surrogate as emitted."""
    if (met := collisions(docs, key).select("kind", "n").take(5)):
        raise AssertionError(f"surrogates are no permutation: {met}")
    return key


def redact(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``_kinds``, the kinds replaced."""
    arrow_limits(docs.sparkSession)
    docs = docs.drop("_kinds")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permutation(key)
        for batch in batches:
            done = [pseudonymise(p, t) if t else (t, []) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([d[0] for d in done], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], pa.list_(pa.string()))], names=[*batch.schema.names, "_kinds"])

    return docs.mapInArrow(run, widened(docs, "_kinds array<string>"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = redact(docs, checked_key(docs))
    return out.select("doc_id", "text", F.size("_kinds").cast("long").alias("n_entities"), F.array_join("_kinds", ",").alias("kinds"))
