"""Surrogates for personal data: every detected entity is replaced by a keyed one of its type and format.

A surrogate is a keyed permutation of the entity's symbols: digits stay digits, letters stay letters of their
script, vowel for vowel and consonant for consonant, hexadecimal digits and address bytes stay such, and
punctuation and case stay in place. Since each format's map is one-to-one, different entities never share a
surrogate, and one entity has the same surrogate in every document, however it is spaced or capitalised.
The maps have no fixed point, so no entity with a known symbol stands for itself.
Card numbers keep their check digit's offset, so valid ones stay valid. Given names of the lists are
turned into other names of the same gender and script; other names are permuted by letters, again
until the result is in no list, and Cyrillic surnames keep the ending that shows the gender. A surname has one
surrogate after every title and given name.

Names are found by titles, by given names of the lists (``names``, by gender and script, is an input), and where a text says
that a name follows ("my name is", "Name:", in four languages). Every pattern reads a text in linear time: none starts within a run
that it could have started at, and all counts are bounded.

Collisions are checked for each entity where it is replaced: the surrogate is turned back with the key and must give the
entity, which no two entities of one surrogate can. ``collisions`` verifies the same over a whole table by comparison.

Nothing is shuffled: the map needs the key alone.

Nulls: null and empty texts stay so, with no entities. Texts are read whole. Repeated rows get the same
result. Empty tables give empty results. Extra columns are ignored. Characters of other alphabets than those
listed stay, and an octet of an address may stay while the address changes.
"""

from __future__ import annotations

import functools
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names by gender and script, and titles by gender.
NAMES = {
    ("m", "latin"): "James John Robert Michael William David Thomas Daniel Paul Mark George Peter Hans Jürgen Karl Pierre Jean Luc Carlos José Luis Miguel".split(),
    ("f", "latin"): "Mary Anna Linda Susan Karen Laura Sarah Emma Julia Alice Helen Ruth Ingrid Sabine Greta Marie Claire Sophie Carmen Lucía Elena Rosa".split(),
    ("m", "cyrillic"): "Иван Пётр Алексей Дмитрий Сергей Андрей Николай Михаил Борис Павел".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Вера Нина".split(),
}
TITLES = {"m": "Mr|Herr|Herrn|Señor|Monsieur|Господин|Господина", "f": "Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mademoiselle|Госпожа", "": "Dr|Prof|Professor|Доктор|Профессор"}
#: What a name follows.
CUES = r"(?i:my name is|i am called|mein name ist|ich heiße|je m'appelle|mon nom est|me llamo|mi nombre es|меня зовут|(?:full |first |last |contact )?name ?[:=]|имя ?[:=])"

_WORD = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]{1,40}(?![a-zß-öø-ÿа-яё])"
_SECRET = r"password|passwd|pwd|secret|token|api[_-]?key"


class Names:
    """Given names by gender and script, and the patterns that find them and everything else."""

    def __init__(self, names: dict[tuple[str, str], list[str]]):
        self.names = {kind: list(dict.fromkeys(x)) for kind, x in names.items()}
        self.listed = {n: (kind, k) for kind, x in self.names.items() for k, n in enumerate(x)}
        if len(self.listed) < sum(map(len, self.names.values())) or any(len(x) == 1 for x in self.names.values()):
            raise ValueError("a name is in one list, and a list has several names")
        titles, given = "|".join(TITLES.values()), "|".join(map(re.escape, sorted(self.listed, key=len, reverse=True))) or "(?!)"
        self.pattern = re.compile(
            r"(?P<email>(?<![\w.+-])[\w.+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,20}[A-Za-z]{2,24}(?![A-Za-z0-9-]))"
            r"|(?P<key>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
            rf"|(?P<secret>(?<![^\W_])(?i:{_SECRET})[\"']?\s{{0,20}}[=:]\s{{0,20}}[\"']?)(?P<value>[^\s\"']{{6,}})"
            r"|(?P<ip>(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9]))"
            r"|(?P<phone>(?<![\w+])(?P<cc>\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9]))"
            r"|(?P<intl>(?<![\w+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9]))"
            r"|(?P<ssn>(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]))"
            r"|(?P<card>(?<![0-9.])(?:[0-9][ -]?){12,18}[0-9](?![0-9]))"
            rf"|\b(?P<title>(?:(?:{titles})\.? ){{1,3}}|{CUES} ?)(?P<name>{_WORD}(?: {_WORD})?)"
            rf"|\b(?P<given>{given}) (?P<surname>{_WORD})")
        #: A text without any of these has no entity, and is passed on unread by the pattern.
        self.hint = re.compile(rf"[@\d]|(?i:{_SECRET})|{titles}|{CUES}|\b(?:{given})\b")


_OWN = Names(NAMES)

_ALPHABETS = ["0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "àáâãäåèéêëìíîïòóôõöùúûü", "çñ"]
_PLACE = {c: (a, k) for a in _ALPHABETS for k, c in enumerate(a)}
_HEX = "0123456789abcdef"
# Endings of names that show a gender.
_ENDING = re.compile(r"(?<=..)(?:ова|ева|ина|ов|ев|ин|ий|ая|а|я|a|o)$")


def _noise(key: bytes, tweak: str, rnd: int, values, n: int) -> list[int]:
    h = hashlib.blake2b(repr((tweak, rnd, values)).encode(), key=key, digest_size=64).digest()
    while len(h) < 4 * n:
        h += hashlib.blake2b(h[-64:], key=key, digest_size=64).digest()
    return [int.from_bytes(h[4 * k: 4 * k + 4], "big") for k in range(n)]


def _mix(values: list[int], sizes: list[int], key: bytes, tweak: str, back: bool = False) -> list[int]:
    """A keyed one-to-one map of digits in mixed bases: each half is shifted by noise from the other, six times."""
    m, v, sign = len(values) // 2, list(values), -1 if back else 1
    for rnd in range(5, -1, -1) if back else range(6):
        a, b = (range(m), slice(m, None)) if rnd % 2 else (range(m, len(v)), slice(0, m))
        for k, x in zip(a, _noise(key, tweak, rnd, v[b], len(a)), strict=True):
            v[k] = (v[k] + sign * x) % sizes[k]
    return v


def permute(values: list[int], sizes: list[int], key: bytes, tweak: str, back: bool = False) -> list[int]:
    """A keyed one-to-one map without fixed points, or its inverse: between two passes of ``_mix``, there and back, a
    keyed number other than 0 is added."""
    v, carry = _mix(values, sizes, key, tweak), 0
    for k, x in enumerate(_noise(key, tweak, -1, [], len(v))):
        x = x % sizes[k] if k else 1 + x % (sizes[k] - 1)
        carry, v[k] = divmod(v[k] + carry + (-x if back else x), sizes[k])
    return _mix(v, sizes, key, tweak, back=True)


def _symbols(text: str, key: bytes, tweak: str, hexa: bool = False, back: bool = False) -> str:
    """Permute the symbols of known alphabets; case and all other characters stay."""
    at, alphabets, values = [], [], []
    for k, c in enumerate(text):
        a, x = (_HEX, _HEX.index(c)) if hexa and c in _HEX else _PLACE.get(c.lower(), (None, 0))
        if a and c in (a[x], a[x].upper()):  # signs such as the Kelvin's have a letter's lower case
            at.append(k)
            alphabets.append(a)
            values.append(x)
    out = list(text)
    for k, a, x in zip(at, alphabets, permute(values, [len(a) for a in alphabets], key, f"{tweak}/{','.join(str(len(a)) for a in alphabets)}", back), strict=True):
        out[k] = a[x].upper() if text[k].isupper() else a[x]
    return "".join(out)


def _luhn(digits: list[int]) -> int:
    """The check digit that the digits before it ask for."""
    return -sum(sum(divmod(d * (2 if k % 2 == 0 else 1), 10)) for k, d in enumerate(reversed(digits))) % 10


def _card(text: str, key: bytes, back: bool) -> str:
    at = [k for k, c in enumerate(text) if c.isdigit()]
    d = [int(text[k]) for k in at]
    new = permute(d[:-1], [10] * (len(d) - 1), key, f"card{len(d)}", back)
    new.append((_luhn(new) + d[-1] - _luhn(d[:-1])) % 10)
    out = list(text)
    for k, x in zip(at, new, strict=True):
        out[k] = str(x)
    return "".join(out)


def _stem(word: str) -> int:
    """Where the ending begins."""
    return m.start() if (m := _ENDING.search(word)) else len(word)


def _name(word: str, key: bytes, back: bool, names: Names = _OWN) -> str:
    """A listed name turns into another of its list; others are permuted, but for an ending that shows the gender, until they are
    in no list."""
    if word in names.listed:
        (kind, k), names = names.listed[word], names.names[names.listed[word][0]]
        order = sorted(range(len(names)), key=lambda j: hashlib.blake2b(f"{kind}/{names[j]}".encode(), key=key).digest())
        return names[order[(order.index(k) + (-1 if back else 1)) % len(order)]]  # a cycle over the whole list: one-to-one, never itself
    end, out = _stem(word), word
    while out == word or out in names.listed or _stem(out) != end:
        now = _symbols(out[:end], key, "name", back=back) + out[end:]
        if now in (out, word):  # no known symbol, or all others are listed
            return word
        out = now
    return out


def _is_hex(text: str) -> bool:
    return all(c in _HEX for c in text) and not text.isdigit() and not text.isalpha()


def _value(text: str, key: bytes, back: bool) -> str:
    """Strings of hexadecimal digits stay such, and no others become such."""
    hexa, out = _is_hex(text), text
    while True:
        out = _symbols(out, key, f"value{hexa}", hexa, back)
        if _is_hex(out) == hexa:
            return out


def _turned(kind: str, text: str, key: bytes, back: bool, names: Names = _OWN) -> str:
    """The surrogate of one entity, or the entity of a surrogate."""
    if kind == "email":
        rest, _, top = text.rpartition(".")
        return _symbols(rest, key, "email", back=back) + "." + top
    if kind == "ip":
        return ".".join(map(str, permute([int(x) for x in text.split(".")], [256] * 4, key, "ip", back)))
    if kind == "card":
        return _card(text, key, back)
    if kind == "name":
        return _name(text, key, back, names)
    if kind == "key":
        return text[:4] + _symbols(text[4:], key, "key", back=back)
    if kind == "value":
        return _value(text, key, back)
    if kind in ("phone", "intl"):
        code = re.match(r"\+\d{1,3}(?=[ .(-])", text)
        code = code[0] if code else ""
        return code + _symbols(text[len(code):], key, "phone" + code, back=back)
    return _symbols(text, key, kind, back=back)


@functools.lru_cache(200_000)
def surrogate(kind: str, text: str, key: bytes, names: Names = _OWN) -> str:
    """The surrogate of one entity (of one word, for names), checked to stand for this entity alone."""
    out = _turned(kind, text, key, False, names)
    if _turned(kind, out, key, True, names) != text:
        raise ValueError(f"the surrogate of this {kind} also stands for another")
    return out


def replace(text: str, key: bytes, names: Names = _OWN) -> tuple[str, list[tuple[str, str, str, int]]]:
    """The text with surrogates, and (type, entity, surrogate, start in the input) of each."""
    if not names.hint.search(text):
        return text, []
    out, found, end = [], [], 0
    for m in names.pattern.finditer(text):
        if m["email"] is None and m["title"]:
            new, kind = m["title"] + " ".join(surrogate("name", w, key, names) for w in m["name"].split(" ")), "name"
        elif m["given"]:
            new, kind = surrogate("name", m["given"], key, names) + " " + surrogate("name", m["surname"], key, names), "name"
        elif m["secret"]:
            new, kind = m["secret"] + surrogate("value", m["value"], key, names), "secret"
        else:
            kind = next(k for k in ("email", "key", "ip", "phone", "intl", "ssn", "card") if m[k])
            new = surrogate(kind, m[0], key, names)
        out += [text[end: m.start()], new]
        found.append((kind, m[0], new, m.start()))
        end = m.end()
    out.append(text[end:])
    return "".join(out), found


def pseudonymise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = b"strataq surrogates", names: dict | None = None) -> DataFrame:
    """id, n_entities, text (with surrogates) and entities (type, entity, surrogate, start). ``names``: given names by
    (gender, script), instead of the module's."""
    given = None if names is None else Names(names)
    kinds = pa.list_(pa.struct([("type", pa.string()), ("entity", pa.string()), ("surrogate", pa.string()), ("start", pa.int64())]))

    def run(batches):
        own = given or _OWN
        for batch in batches:
            texts, n, every = [], [], []
            for t in batch.column(1).to_pylist():
                new, found = (t, []) if t is None else replace(t, key, own)
                texts.append(new)
                n.append(len(found))
                every.append([dict(zip(("type", "entity", "surrogate", "start"), f, strict=True)) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(texts, pa.string()), pa.array(every, kinds)], names=["id", "n_entities", "text", "entities"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_entities long, text string, entities array<struct<type:string,entity:string,surrogate:string,start:long>>")


def collisions(done: DataFrame) -> DataFrame:
    """type, surrogate of those that stand for several entities: none, if the map is one-to-one. Entities are compared
    without case and punctuation, as the map reads them."""
    e = done.select(F.explode("entities").alias("e")).select("e.*")
    plain = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "))
    return e.groupBy("type", plain("surrogate").alias("surrogate")).agg(F.min(plain("entity")).alias("a"), F.max(plain("entity")).alias("b")).where("a != b").select("type", "surrogate")
