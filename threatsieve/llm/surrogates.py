"""PII: detected entities are replaced by keyed surrogates of the same type and format.

A surrogate is the image of its entity under a keyed permutation of all strings of the entity's own form: the
digits of a phone number between the same signs, the letters and digits of an address, valid card numbers of one
length and first digit, given names of one gender, family names with the same pattern of vowels, consonants and
capitals in the same script. A permutation gives distinct entities distinct surrogates and one entity the same surrogate
in every document, on every machine, without a table of entities; it never maps a value to itself where the form holds
two values or more. Per document the result is checked: a surrogate that is itself an entity of the document is
permuted on, and two entities never share one; only there may an entity's surrogate differ from that in other documents.
Whoever has the key can undo the surrogates.

Types: e-mail address, IPv4 address, payment card (with its check digit), IBAN (with its check digits), US social
security number, phone number, secret after a naming word or of a known form, name after a title or given name and bare repeats of its parts.

Defined results: a null text stays null and has no entities; texts without entities stay as they are byte for byte;
repeated rows give repeated rows; an empty table gives an empty result; ``n_chars``, where there is such a column, follows the text;
other columns stay as they are.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T



ROUNDS = 6
# The key of the registered queries where the session has none: it is public, so anyone can undo their surrogates.
DEFAULT_KEY = b"change this key for each release"
KEY_SETTING = "spark.threatsieve.surrogateKey"

# Given names by gender, as lists that are permuted in themselves.
GIVEN = {
    "f": (
        "Alice", "Amanda", "Amelia", "Andrea", "Angela", "Anna", "Barbara", "Beatriz", "Camille", "Carmen", "Caroline", "Catherine", "Charlotte", "Chloe", "Christine", "Claire", "Daniela", "Deborah", "Diana", "Dorothy", "Eleanor", "Elena", "Elizabeth", "Emily", "Emma", "Fatima", "Francesca", "Gabriela", "Hannah", "Helen", "Ingrid", "Isabel", "Jane", "Jennifer", "Jessica", "Julia", "Karen", "Katharina", "Laura", "Linda", "Lisa", "Lucia", "Margaret", "Maria", "Martina", "Mary", "Michelle", "Monika", "Nancy", "Natalie", "Olivia", "Patricia", "Paula", "Petra", "Rachel", "Rebecca", "Sabine", "Sandra", "Sarah", "Sofia", "Sophie", "Susan", "Teresa", "Ursula", "Valentina", "Victoria", "Yvonne", "Zoe",
    ),
    "m": (
        "Adrian", "Albert", "Alejandro", "Alexander", "Andrew", "Anthony", "Antoine", "Benjamin", "Bernard", "Brian", "Carlos", "Charles", "Christian", "Christopher", "Daniel", "David", "Diego", "Dieter", "Edward", "Eric", "Fernando", "Francisco", "Frank", "Friedrich", "George", "Gustav", "Hans", "Heinrich", "Henry", "Jack", "Jacques", "James", "Javier", "Jean", "John", "Jonathan", "Jorge", "Joseph", "Juan", "Klaus", "Kevin", "Lucas", "Luis", "Manuel", "Marcel", "Mark", "Martin", "Matthew", "Michael", "Miguel", "Nicolas", "Oliver", "Oscar", "Patrick", "Paul", "Pedro", "Peter", "Philip", "Pierre", "Richard", "Robert", "Samuel", "Stefan", "Steven", "Thomas", "Timothy", "Victor", "Walter", "William", "Wolfgang",
    ),
}
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Professor", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Don", "Doña")
# Vowels and consonants of the scripts that surrogates keep.
LETTERS = {
    "latin": ("aeiou", "bcdfghjklmnpqrstvwxyz"),
    "greek": ("αεηιουω", "βγδζθκλμνξπρστφχψ"),
    "cyrillic": ("аеиоуыэюя", "бвгджзклмнпрстфхцчшщ"),
}

# Local parts have up to 64 characters; unbounded, each dot of a long run would begin a walk over the rest.
_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+%-]{0,62}[\w+%-])?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![\w-])|(?<!\w)[^\W_][\w.+%-]{0,63}@[\w-]+(?:\.[\w-]+)+")
_IPV4 = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)")
# A run of digit groups that may hold a card; the usual groups of one.
_CARD = re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,}+")
_CARD_GROUPS = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5}")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_IBAN_HEAD = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?= ?[A-Z0-9]{4})")
# The length of an IBAN by country.
IBAN_LENGTHS = dict(
    part.split(":") for part in "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 EE:20 EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MR:27 MT:31 MU:30 NL:18 NO:15 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:24 SC:31 SD:18 SE:24 SI:19 SK:24 SM:27 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20".split()
)
_PHONE = re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w)|(?<![\w.+-])\+\d{1,3}(?:[ .-]?\d{2,5}){2,5}(?!\w)|(?<![\w.+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?!\w|-\d)")
# National forms: with a leading 1, with a trunk 0 or 00 (9 to 15 digits, no date), and any after a naming word.
_TRUNK = re.compile(
    r"(?<![\w.+-])1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}(?!\w|-\d)"
    r"|(?<![\w.+-])(?!\d\d([./-])\d\d\1\d{4})(?=(?:[ ./-]?\d){9,15}(?![ ./-]?\d\d))0\d{1,4}(?:[ ./-]\d{2,8}){1,4}(?!\w|[.-]\d)"
)
_CALLED = re.compile(
    r"(?i:\b(?:tel|telefon|tel[ée]fono|t[ée]l[ée]phone|phone|mobile?|m[óo]vil|cell|fax|handy|portable|whatsapp)\b\.?(?: ?(?:no|nr|number|n°|nummer|n[úu]mero|num[ée]ro)\b\.?)?(?: (?:is|ist|es|est))?\s?[:=]?\s{0,2})"
    r"(?P<number>(?!\d{4}-\d\d-\d\d|\d\d?[./]\d\d?[./]\d{4})\(?\d(?:[ ./()-]{0,2}\d){6,14})(?!\w|[.-]\d)"
)
_SECRET = re.compile(
    r"(?i:\b(?:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|auth[_-]?token|token|passwd|password|pwd|bearer)\b[\"']?\s{0,3}[:=]?\s{0,3}[\"']?)"
    r"(?P<value>(?:(?<==)|(?<==[\"' ])|(?<== [\"'])|(?=[A-Za-z0-9+/_-]*\d))[A-Za-z0-9+/_-]{8,})"
    r"|(?<!\w)(?P<known>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,})(?!\w)"
)
_MARKS = ("=", "AKIA", "sk-", "xox", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")
_UP = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]"
_NAME = rf"{_UP}[^\W\d_]+(?:[-'’]{_UP}?[^\W\d_]+)?"
_TITLED = re.compile(rf"\b(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\.?[ \u00a0](?P<name>{_NAME}(?: {_UP}\.)?(?: {_NAME})?)")
_GIVEN_OF = {name: gender for gender, names in GIVEN.items() for name in names}
_NAMED = re.compile(rf"(?P<name>{_NAME} (?:{_UP}\. )?{_NAME})")

Entity = tuple[int, int, str]


def permuted(index: int, size: int, key: bytes, tweak: str) -> int:
    """The image of ``index`` under a keyed permutation of ``range(size)`` that leaves no place fixed."""
    if size < 2:
        return index
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    low, wide = (1 << half) - 1, -(-half // 8)
    salt = f"{tweak}/{size}/".encode()

    def mix(number: int, turn: int) -> int:
        data = salt + bytes([turn]) + number.to_bytes(wide, "little")
        if wide <= 64:
            return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=wide).digest(), "little") & low
        return int.from_bytes(hashlib.shake_256(key + data).digest(wide), "little") & low

    def forward(x: int) -> int:
        while True:  # walks until it is back among the first ``size`` places
            a, b = x >> half, x & low
            for turn in range(ROUNDS):
                a, b = b, a ^ mix(b, turn)
            x = a << half | b
            if x < size:
                return x

    def backward(x: int) -> int:
        while True:
            a, b = x >> half, x & low
            for turn in reversed(range(ROUNDS)):
                a, b = b ^ mix(a, turn), a
            x = a << half | b
            if x < size:
                return x

    return forward((backward(index) + 1) % size)


def _classes() -> dict[str, str]:
    found = {}
    for vowels, consonants in LETTERS.values():
        for letters in (vowels, consonants, vowels.upper(), consonants.upper()):
            for letter in letters:
                found.setdefault(letter, letters)
    return found | {d: "0123456789" for d in "0123456789"}


_CLASS = _classes()
_HEX = {**{c: "abcdef" for c in "abcdef"}, **{c: "ABCDEF" for c in "ABCDEF"}, **{c: "0123456789" for c in "0123456789"}}
_DIGITS = {c: "0123456789" for c in "0123456789"}


def shaped(text: str, key: bytes, kind: str, classes: dict[str, str], free: Callable[[int], bool] = lambda at: True) -> str:
    """Permutes the characters that have a class, each within it; all others stay."""
    index, size, form, places = 0, 1, [], []
    for at, c in enumerate(text):
        letters = classes.get(c) if free(at) else None
        if letters:
            index, size = index * len(letters) + letters.index(c), size * len(letters)
            places.append((at, letters))
            form.append(letters[0])
        else:
            form.append("=" + c)
    index = permuted(index, size, key, kind + "".join(form))
    out = list(text)
    for at, letters in reversed(places):
        index, digit = divmod(index, len(letters))
        out[at] = letters[digit]
    return "".join(out)


def luhn(digits: str) -> int:
    """The sum that is a multiple of ten for valid card numbers."""
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total


def _card(text: str, key: bytes) -> str:
    digits = [i for i, c in enumerate(text) if c.isdigit()]
    changed = shaped(text, key, "card", _DIGITS, lambda at: at not in (digits[0], digits[-1]))
    body = "".join(changed[i] for i in digits[:-1])
    return changed[: digits[-1]] + str(-luhn(body + "0") % 10) + changed[digits[-1] + 1 :]


def iban_rest(text: str) -> int:
    """1 for valid IBANs."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _iban(text: str, key: bytes) -> str:
    changed = shaped(text, key, "iban", _CLASS | {c: "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, lambda at: at >= 4)
    return changed[:2] + f"{98 - iban_rest(changed[:2] + '00' + changed[4:]):02d}" + changed[4:]


def _ipv4(text: str, key: bytes) -> str:
    number = int.from_bytes(bytes(map(int, text.split("."))), "big")
    return ".".join(map(str, permuted(number, 1 << 32, key, "ipv4").to_bytes(4, "big")))


def _email(text: str, key: bytes) -> str:
    end = text.rindex(".")
    return shaped(text, key, "email", _CLASS, lambda at: at < end)


def _phone(text: str, key: bytes) -> str:
    country = re.match(r"\+\d{1,3}(?=[ .(-])|0|1(?=[ .-])", text)
    start = country.end() if country else 0
    return shaped(text, key, "phone", _DIGITS, lambda at: at >= start)


def _secret(text: str, key: bytes) -> str:
    known = re.match(r"AKIA|gh[pousr]_|sk-|xox[abprs]-", text)
    start = known.end() if known else 0
    classes = _HEX if all(c in _HEX for c in text) else _CLASS
    return shaped(text, key, "secret", classes, lambda at: at >= start)


def _word(word: str, key: bytes) -> str:
    gender = _GIVEN_OF.get(word)
    if gender:
        names = GIVEN[gender]
        return names[permuted(names.index(word), len(names), key, "given" + gender)]
    # Letters with marks keep them: the mark is set apart, and put back on the new letter.
    apart = unicodedata.normalize("NFD", word)
    changed = unicodedata.normalize("NFC", shaped(apart, key, "family", _CLASS))
    return changed if changed not in _GIVEN_OF else _word_again(changed, key)


def _word_again(word: str, key: bytes) -> str:
    """A family name never becomes a listed given name: it is permuted on."""
    while word in _GIVEN_OF:
        word = unicodedata.normalize("NFC", shaped(unicodedata.normalize("NFD", word), key, "family", _CLASS))
    return word


def _name(text: str, key: bytes) -> str:
    return re.sub(r"[^\W\d_]+", lambda m: _word(m[0], key), text)


MAKERS: dict[str, Callable[[str, bytes], str]] = {
    "email": _email, "ipv4": _ipv4, "card": _card, "iban": _iban, "ssn": lambda t, k: shaped(t, k, "ssn", _DIGITS),
    "phone": _phone, "secret": _secret, "name": _name,
}


def _cards(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The cards in a run of digit groups: those in usual groups first, then others, from each group on the longest."""
    groups = [m.span() for m in re.finditer(r"\d+", text[start:end])]
    found: list[tuple[int, int]] = []
    for usual in (True, False):
        at = 0
        while at < len(groups):
            a, upto = groups[at][0] + start, at
            size, fits = 0, []
            while upto < len(groups) and size + groups[upto][1] - groups[upto][0] <= 19:
                size += groups[upto][1] - groups[upto][0]
                if size >= 13:
                    fits.append(upto)
                upto += 1
            for last in reversed(fits if text[a] in "23456" else []):
                b = groups[last][1] + start
                if re.match(r"\w|\.\d", text[b : b + 2]) or (usual and not _CARD_GROUPS.fullmatch(text, a, b)) or any(a < y and b > x for x, y in found):
                    continue
                if luhn("".join(c for c in text[a:b] if c.isdigit())) % 10 == 0:
                    found.append((a, b))
                    at = last
                    break
            at += 1
    return sorted(found)


def _ibans(text: str) -> list[tuple[int, int]]:
    """The IBANs: of the country's length, else the longest, else to a shorter group's end."""
    found = []
    for head in _IBAN_HEAD.finditer(text):
        longest = _IBAN.match(text, head.start())
        sizes = [int(IBAN_LENGTHS.get(head[0][:2], 0)), *range(len(longest[0].replace(" ", "")) if longest else 0, 11, -1)]
        for size in filter(None, sizes):
            rest = f"(?: ?[A-Z0-9]{{{size % 4}}})" if size % 4 else ""
            m = re.compile(rf"[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{{size // 4 - 1}}}{rest}(?!\w)").match(text, head.start())
            if m and iban_rest(m[0]) == 1:
                found.append(m.span())
                break
    return found


def entities(text: str) -> list[Entity]:
    """``start, end, type`` of all entities, in order, none overlapping; types found first win."""
    found: list[Entity] = []
    taken: list[tuple[int, int]] = []  # in order, none overlapping

    def add(start: int, end: int, kind: str) -> None:
        at = bisect.bisect(taken, (start, end))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
            found.append((start, end, kind))
            taken.insert(at, (start, end))

    digit = re.search(r"\d", text) is not None
    if digit or any(mark in text for mark in _MARKS):
        for m in _SECRET.finditer(text):
            group = "value" if m["value"] else "known"
            add(m.start(group), m.end(group), "secret")
    if "@" in text:
        for m in _EMAIL.finditer(text):
            add(*m.span(), "email")
    if digit:
        for a, b in _ibans(text):
            add(a, b, "iban")
        for m in _IPV4.finditer(text):
            add(*m.span(), "ipv4")
        for m in _CARD.finditer(text):
            for a, b in _cards(text, *m.span()):
                add(a, b, "card")
        for pattern, kind in ((_SSN, "ssn"), (_PHONE, "phone")):
            for m in pattern.finditer(text):
                add(*m.span(), kind)
        for m in _TRUNK.finditer(text):
            add(*m.span(), "phone")
        for m in _CALLED.finditer(text):
            add(*m.span("number"), "phone")
    for m in _TITLED.finditer(text):
        add(*m.span("name"), "name")
    at = 0
    while m := _NAMED.search(text, at):
        first = m[0].split(" ", 1)[0]
        if first in _GIVEN_OF:
            add(*m.span(), "name")
            at = m.end()
        else:
            at = m.start() + len(first)
    # Bare repeats of the parts of the names found so far.
    parts = {w for a, b, kind in found if kind == "name" for w in name_parts(text[a:b])}
    if parts:
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(sorted(parts))})(?!\w)", text):
            add(*m.span(), "name")
    return sorted(found)


def name_parts(name: str) -> list[str]:
    """The words of a name that stand for it alone: no initials and titles."""
    return [w for w in re.findall(r"[^\W\d_]{2,}", name) if w not in TITLES]


def replaced(text: str, key: bytes) -> tuple[str, list[Entity]]:
    """The text with surrogates, and the entities of the original."""
    found = entities(text)
    if not found:
        return text, found
    originals = {(kind, text[a:b]) for a, b, kind in found}
    made: dict[tuple[str, str], str] = {}
    used: set[str] = set()
    values = {value for _, value in originals}
    turns: dict[str, int] = {}  # by part of a longer name: how often that was permuted
    for kind, value in sorted(originals, key=lambda o: (o[0], -o[1].count(" "), o[1])):
        surrogate = MAKERS[kind](value, key)
        tries = 0
        if kind == "name" and value in turns:  # as in the longer name
            for _ in range(turns[value]):
                surrogate = MAKERS[kind](surrogate, key)
            made[kind, value] = surrogate
            used.add(surrogate)
            continue
        while (surrogate in values or surrogate in used) and tries < 1000:
            surrogate, tries = MAKERS[kind](surrogate, key), tries + 1
        made[kind, value] = surrogate
        used.add(surrogate)
        if kind == "name":
            for part in name_parts(value):
                turns.setdefault(part, tries)
    out, at = [], 0
    for a, b, kind in found:
        out += [text[at:a], made[kind, text[a:b]]]
        at = b
    return "".join([*out, text[at:]]), found


def key_of(spark: SparkSession) -> bytes:
    """The session's key, as text in ``KEY_SETTING``; the public one where it is unset."""
    return spark.conf.get(KEY_SETTING, DEFAULT_KEY.decode()).encode()


def with_surrogates(docs: DataFrame, key: bytes, counts: bool = False) -> DataFrame:
    """``docs`` with replaced texts; with ``counts`` also ``n_entities`` and ``kinds`` (a count per type)."""
    text_at = docs.columns.index("text")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    shape = docs.schema
    if counts:
        more = [T.StructField("n_entities", T.IntegerType()), T.StructField("kinds", T.StringType())]
        shape = T.StructType([*docs.drop("n_entities", "kinds").schema.fields, *more])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            done = [(None, []) if t is None else replaced(t, key) for t in texts]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            if any(found for _, found in done):
                columns["text"] = pa.array([t for t, _ in done], batch.schema.field("text").type)
                if chars_at is not None:
                    sizes = [n if not found else len(t) for n, (t, found) in zip(columns["n_chars"].to_pylist(), done, strict=True)]
                    columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            if counts:
                kinds = [sorted(k for _, _, k in found) for _, found in done]
                columns["n_entities"] = pa.array([len(k) for k in kinds], pa.int32())
                columns["kinds"] = pa.array([",".join(f"{k}:{row.count(k)}" for k in dict.fromkeys(row)) for row in kinds])
            yield pa.record_batch([columns[f.name] for f in shape], [f.name for f in shape])

    return docs.mapInArrow(run, shape)


def op8_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").cast("string").alias("text"))
    return with_surrogates(docs, key_of(spark), counts=True)
