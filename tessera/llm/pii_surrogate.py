"""PII surrogate generation.

Entities (mail addresses, phone, card, account and social security numbers, IPv4 and IPv6
addresses, secrets, access keys, titled person names) are found by pattern and get keyed surrogates
of their own type: digits for digits and letters for letters in the same places, a valid
check digit where the original has one, name parts in the same script and of the gender
that the title tells, if it does (in scripts other than Latin, Cyrillic and Greek as many
letters of the script's block, without gender).  A second pass finds the names of a text where they stand
in it without a title (with a capital, if the script has any).  Initials and particles may stand
among the parts of a name: an initial is an entity of its own, drawn as two letters ("J." may
become "Ke."), since one letter leaves no room beside the letters that occur; a particle ("von")
stays.  Mentions that differ only
in case or punctuation are one entity; IPv6 surrogates are written in full.

The map from entities to surrogates is one-to-one over the whole input (parts of names of all
kinds taken together), and no surrogate equals an entity that occurs: every distinct entity draws a candidate from an HMAC of
the key, its type, itself and the number of the try; a candidate that is an existing
entity, is taken, or is drawn by several (the one of least hash wins) is drawn again in
the next round, until none is left.  After ``WIDEN`` rounds numbers grow by a digit every
few rounds, so a format with more entities than free surrogates ends no job.  So equal entities stay equal and different ones
different in every document.  Texts without a trace of an entity never shuffle.

Defined results: a null text stays null with no entity; a text without an entity is
returned unchanged; overlapping matches: the first, then the longest type in the order
below; rows alike in id and text get the same result; an empty table gives an empty
result; other columns pass through (``n_entities`` and ``entities`` are replaced).
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tessera.llm.common import Scratch, slices

SLICE = 1 << 20
SALT = 32
ROUNDS, WIDEN = 64, 24

#: Titles that tell the gender of the name behind them (fixed values, by language).
MALE = ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н", "κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Doña",
          "госпожа", "г-жа", "κυρία"]
#: Titles that do not tell it; they may also stand behind another title.
NEUTRAL = ["Dr", "Prof", "Professor", "Doctor", "Doktor", "Docteur", "доктор", "профессор", "Δρ"]
TITLE = {t.casefold(): g for g, ts in (("M", MALE), ("F", FEMALE), ("X", NEUTRAL)) for t in ts}



def _any(titles: list[str]) -> str:
    return "|".join(re.escape(t).replace(r"\-", "-") for t in sorted(
        {*titles, *map(str.upper, titles)}, key=lambda t: (-len(t), t)))


_titles, _neutral = _any(MALE + FEMALE + NEUTRAL), _any(NEUTRAL)
#: Small words between the parts of a name (fixed values, by language).
PARTICLES = ["von", "vom", "zu", "zum", "zur", "van", "der", "den", "ten", "ter", "de", "del", "della", "di", "da",
             "do", "dos", "das", "du", "des", "la", "las", "le", "los", "el", "al", "bin", "ibn"]
_capital = r"[^\W\d_a-zß-öø-ÿа-яёα-ωά-ώ]"
_initials = rf"(?:{_capital}\.[ ]?)*"
_particles = rf"(?:(?:{'|'.join(PARTICLES)})[ ])*"
_part = rf"(?:{_capital}['’](?={_capital}))?{_capital}[^\W\d_]+(?:['’]{_capital}[^\W\d_]+)?"
#: Letters of a domain beside those of ASCII: Latin, Greek and Cyrillic ones.
_wide = "A-Za-z\u00c0-\u024f\u0370-\u052f"
_octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_ip4 = rf"(?:{_octet}\.){{3}}{_octet}"
_hex = r"[0-9A-Fa-f]{1,4}"
_year = r"(?:19|20)\d\d"
PATTERN = re.compile(rf"""
      (?P<mail>[\w.%+-]+@[{_wide}0-9-]+(?:\.[{_wide}0-9-]+)*\.[{_wide}]{{2,}})
    | \b(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|auth)\b["']?(?:\s*[:=]\s*|[ ]is[ ](?=["']?[A-Za-z+/_-]*\d))["']?(?P<secret>[A-Za-z0-9+/_-]{{12,}})
    | (?<![0-9A-Za-z])(?P<access>(?:AKIA|ASIA)[0-9A-Z]{{16}}|gh[opsu]_[0-9A-Za-z]{{36}})(?![0-9A-Za-z])
    | (?<![0-9A-Za-z])(?P<hex>(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{{32,}})(?![0-9A-Za-z])
    | (?<![\w:])(?P<ip6>(?:{_hex}:){{7}}{_hex}
        | (?=[0-9A-Fa-f:.]*[0-9])(?!(?:[0-9A-Fa-f]*:){{9}})(?:
            ::(?:{_hex}:){{0,5}}{_ip4} | (?:{_hex}:){{1,6}}(?::{_hex}){{1,6}} | ::(?:{_hex}:){{0,6}}{_hex}
            | (?:{_hex}:){{1,7}}:))(?![\w:]|\.\d)
    | (?<![\d.])(?P<ip>{_ip4})(?!\.?\d)
    | (?<![0-9A-Za-z])(?P<iban>[A-Z]{{2}}\d\d(?:[ ]?[A-Z0-9]{{4}}){{3,7}}(?:[ ]?[A-Z0-9]{{1,3}})?)(?![0-9A-Za-z])
    | (?<![\w+])(?P<card>\d{{4}}(?:[ -]?\d{{4}}){{2}}[ -]?\d{{1,7}}|\d{{13,19}})(?![\w])
    | (?<![\w-])(?P<ssn>\d{{3}}-\d\d-\d{{4}})(?![\w-])
    | (?<![\w+])(?P<phone>\+1[ .-]?(?:\(\d{{3}}\)|\d{{3}})[ .-]?\d{{3}}[ .-]?\d{{4}}
        | \+\d(?:(?:[ ./-]|[ ]?\(|\)[ .-]?)?\d){{7,14}}
        | 0\d(?:[ .-]\d\d){{4}}
        | (?!{_year}-{_year}(?!\d))(?<!19\d\d-)(?<!20\d\d-)
          (?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)|\d{{2,4}})[ .-]?\d{{3,4}}[ .-]\d{{3,4}}
        | (?:0\d{{1,4}}[ /-]|\(0\d{{1,5}}\)[ ]?)(?:\d{{5,8}}|\d{{3,4}}[ -]\d{{3,5}})
        | (?<![.-])\d{{3}}-\d{{4}}(?!-\w))(?![\w])
    | (?<!\w)(?P<title>{_titles})\.?[ ](?:(?:{_neutral})\.?[ ])*(?!(?:{_neutral})\b)(?P<name>{_initials}{_particles}{_part}(?:(?:[ ]{_initials}{_particles}|-){_part}){{0,2}})
    """, re.X)
WORD = re.compile(r"(?<!\w)[^\W\d_]+(?!\w)")
#: The parts of a found name: initials with their dot, names; particles are skipped.
PART = re.compile(rf"(?P<initial>{_capital})\.|(?<!\w){_part}")
#: Java patterns that every text with an entity matches: a digit or at sign, an assigned secret, an
#: address without digits, a title before a particle or a letter that is not a small one of ASCII.
NUMBER = r"[\p{Nd}@]"
ASSIGNED = r"(?iu)(?:token|secret|passw(?:or)?d|key|auth)[\"']?[\s\p{Z}\x1c-\x1f\x85]*[:=]"
ADDRESS = r"(?:[A-Fa-f]{1,4}:){7}"
TITLED = (rf"(?=[{''.join(sorted({t[0] for t in _titles.split('|')}))}])(?:{_titles})"
          rf"\.? (?:[A-Z\x{{80}}-\x{{10FFFF}}]|(?:{'|'.join(PARTICLES)}) )")
#: What access keys start with; those of other makes hold a digit in all likelihood, yet need not.
ACCESS = r"A[KS]IA[0-9A-Z]|gh[opsu]_"


def has_trace(text: Column) -> Column:
    """True for every text that may hold an entity (cheap tests first)."""
    return F.coalesce(text.rlike(NUMBER) | ((text.contains("=") | text.contains(":")) & text.rlike(ASSIGNED))
                      | (text.contains(":") & text.rlike(ADDRESS)) | text.rlike(ACCESS) | text.rlike(TITLED),
                      F.lit(False))


CONSONANTS = {"latin": "bdfgklmnprstvz", "cyrillic": "бвгдзклмнпрст", "greek": "βγδζκλμνπρστ"}
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αειου"}
FINAL = {("latin", "F"): "a", ("cyrillic", "F"): "а", ("greek", "F"): "α",
         ("latin", "M"): "n", ("cyrillic", "M"): "н", ("greek", "M"): "ς"}


#: Other scripts: their block, and the letters of it that surrogates are made of (fixed values).
BLOCKS = {"armenian": ("\u0530", "\u058f", "\u0561", "\u0586"), "hebrew": ("\u0590", "\u05ff", "\u05d0", "\u05ea"),
          "arabic": ("\u0600", "\u06ff", "\u0628", "\u063a"), "devanagari": ("\u0900", "\u097f", "\u0915", "\u0939"),
          "bengali": ("\u0980", "\u09ff", "\u0995", "\u09a8"), "tamil": ("\u0b80", "\u0bff", "\u0bae", "\u0bb9"),
          "thai": ("\u0e00", "\u0e7f", "\u0e01", "\u0e2e"), "georgian": ("\u10a0", "\u10ff", "\u10d0", "\u10f0"),
          "hiragana": ("\u3040", "\u309f", "\u304b", "\u3062"), "katakana": ("\u30a0", "\u30ff", "\u30ab", "\u30c2"),
          "han": ("\u3400", "\u9fff", "\u4e00", "\u9fa5"), "hangul": ("\uac00", "\ud7af", "\uac00", "\ud7a3")}


def script(word: str) -> str:
    for c in word:
        if "Ѐ" <= c <= "ԯ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
        if c > "ԯ":
            for name, (low, high, _, _) in BLOCKS.items():
                if low <= c <= high:
                    return name
    return "latin"


def block_letter(name: str, s: "Stream") -> str:
    """A letter of a script outside ``CONSONANTS``."""
    _, _, low, high = BLOCKS[name]
    return chr(ord(low) + s.below(ord(high) - ord(low) + 1))


def mentions(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, type, canonical entity) of each mention, in order and without overlap.

    Name parts are entities of their own: the last one a surname, the others given names
    of the title's gender (X if it tells none and no other title of the text does), so a
    person is the same with and without the given name, and with and without the title.
    """
    found = list(_patterned(text))
    known: dict[str, list[str]] = {}
    for _, _, kind, entity in found:
        if (kind == "surname" or kind.startswith("given_")) and kind not in known.setdefault(entity, []):
            known[entity].append(kind)
    if not known:
        yield from found
        return
    for entity, kinds in known.items():
        if "given_X" in kinds and len(told := [k for k in kinds if k in ("given_M", "given_F")]):
            kinds.remove("given_X")
            found = [(a, e, told[0] if k == "given_X" and x == entity else k, x) for a, e, k, x in found]
    bare, at, done = [], 0, 0
    words = list(WORD.finditer(text))
    for i, w in enumerate(words):
        while at < len(found) and found[at][1] <= w.start():
            at += 1
        if w.start() < done or w.group()[0].islower():
            continue
        entity, end, n = w.group().casefold(), w.end(), i + 1
        if n < len(words) and text[end:words[n].start()] in ("'", "’"):
            joined = f"{entity}'{words[n].group().casefold()}"
            if joined in known:
                entity, end, n = joined, words[n].end(), n + 1
        gap = text[end:words[n].start()] if n < len(words) else ""
        while n + 1 < len(words) and words[n].group() in PARTICLES and text[words[n].end():words[n + 1].start()] == " ":
            n += 1
        after = words[n].group().casefold() if n < len(words) else ""
        if n + 1 < len(words) and text[words[n].end():words[n + 1].start()] in ("'", "’"):
            joined = f"{after}'{words[n + 1].group().casefold()}"
            after = joined if joined in known else after
        if at < len(found) and found[at][0] < end:
            continue
        if len(entity) == 1 and gap in (". ", ".") and "surname" in known.get(after, []):
            bare.append((w.start(), end, "initial", entity))
        if entity not in known:
            continue
        kinds, done = known[entity], end
        first = gap in (" ", "-") and "surname" in known.get(after, [])
        fit = [k for k in kinds if (k != "surname") == first]
        bare.append((w.start(), end, (fit or kinds)[0], entity))
    yield from sorted(found + bare)


def _patterned(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Mentions that the pattern finds."""
    for m in PATTERN.finditer(text):
        kind = m.lastgroup
        if kind == "name":
            gender = TITLE[m.group("title").casefold()]
            parts = list(PART.finditer(text, m.start("name"), m.end("name")))
            for i, p in enumerate(parts):
                if p.group("initial"):
                    yield *p.span("initial"), "initial", p.group("initial").casefold()
                    continue
                t = "surname" if i == len(parts) - 1 else "given_" + gender
                yield *p.span(), t, p.group().casefold().replace("’", "'")
            continue
        value = m.group(kind)
        if kind in ("card", "ssn"):
            value = re.sub(r"\D", "", value)
        elif kind == "phone":  # the country code stays apart: "+1-..."
            code = re.match(r"\+\d{1,3}(?=[ .-])", value)
            n = code.end() if code else 0
            value = (value[:n] + "-" if n else "") + re.sub(r"\D", "", value[n:])
        elif kind == "iban":
            value = value.replace(" ", "").upper()
        elif kind == "ip6":
            try:
                digits = f"{int(ipaddress.IPv6Address(value)):032x}"
                value = ":".join(digits[i:i + 4] for i in range(0, 32, 4))
            except ValueError:  # too many groups beside "::"
                value = value.casefold()
        elif kind in ("mail", "hex"):
            value = value.casefold()
        yield m.start(kind), m.end(kind), kind, value


# -------------------------------------------------------------------- surrogates

class Stream:
    """Keyed numbers for one draw."""

    def __init__(self, key: bytes, kind: str, entity: str, trial: int):
        self.key, self.seed, self.n, self.pool = key, f"{kind}\0{entity}\0{trial}".encode(), 0, 0
        self.left = 0

    def below(self, k: int) -> int:
        if self.left < 1 << 16:
            d = hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.pool, self.left, self.n = int.from_bytes(d, "big"), 1 << 256, self.n + 1
        self.pool, r = divmod(self.pool, k)
        self.left //= k
        return r


def luhn(digits: str) -> int:
    """Check digit that completes ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    n = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(n) % 97:02d}"


def like(value: str, s: Stream) -> str:
    """Digits for digits, letters for letters of the same case and script, the rest as it is."""
    out = []
    for c in value:
        if c.isdigit():
            out.append(str(s.below(10)))
        elif c.isalpha():
            kind = script(c)
            if kind in BLOCKS:
                out.append(block_letter(kind, s))
                continue
            pool = VOWELS[kind] if c.casefold() in VOWELS[kind] else CONSONANTS[kind]
            x = pool[s.below(len(pool))]
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def draw(key: bytes, kind: str, entity: str, trial: int) -> str:
    """Candidate surrogate (canonical) of an entity."""
    s = Stream(key, kind, entity, trial)
    if kind == "mail":
        local, _, domain = entity.rpartition("@")
        return like(local, s) + "@" + "".join("abcdefghijklmnopqrstuvwxyz"[s.below(26)] for _ in range(8)) + ".example"
    if kind == "hex":
        return "".join("0123456789abcdef"[s.below(16)] for _ in entity)
    if kind == "access":  # the maker's letters stay
        return entity[:4] + like(entity[4:], s)
    if kind == "secret":
        return "".join("0123456789abcdef"[s.below(16)] if re.fullmatch(r"[0-9a-f]+", entity) else
                       "0123456789ABCDEF"[s.below(16)] if re.fullmatch(r"[0-9A-F]+", entity) else like(c, s)
                       for c in entity)
    if kind == "ip":
        return ".".join(str(1 + s.below(254)) for _ in range(4))
    if kind == "ip6":
        return ":".join(f"{0x1000 + s.below(0xF000):x}" for _ in range(8))
    if kind == "card":
        body = entity[0] + "".join(str(s.below(10)) for _ in entity[1:-1])
        valid = luhn(entity[:-1]) == int(entity[-1])
        return body + str(luhn(body) if valid else s.below(10))
    if kind == "iban":
        rest = "".join(str(s.below(10)) if c.isdigit() else chr(65 + s.below(26)) for c in entity[4:])
        return entity[:2] + iban_check(entity[:2], rest) + rest
    if kind in ("ssn", "phone"):
        code, dash, digits = entity.rpartition("-")
        more = max(0, (trial - WIDEN) // 4 + 1)
        return code + dash + "".join(str(s.below(10)) for _ in range(len(digits) + more))
    # name parts: syllables of the script, ended by gender; more of them with every few tries
    front, mark, entity = entity.rpartition("'")
    if mark:
        return like(front, s) + mark + syllables(kind, entity, trial, s)
    return syllables(kind, entity, trial, s)


def syllables(kind: str, entity: str, trial: int, s: Stream) -> str:
    sc = script(entity)
    if sc in BLOCKS:
        return "".join(block_letter(sc, s) for _ in range(len(entity) + trial // 4))
    gender = kind[-1] if kind.startswith("given") else None
    n = (1 if kind == "initial" else max(2, min(5, len(entity) // 2))) + trial // 4
    word = "".join(CONSONANTS[sc][s.below(len(CONSONANTS[sc]))] + VOWELS[sc][s.below(len(VOWELS[sc]))] for _ in range(n))
    if kind == "initial":
        return word
    if gender == "F":
        return word[:-1] + FINAL[sc, "F"]
    return word + (FINAL[sc, "M"] if gender == "M" else CONSONANTS[sc][s.below(len(CONSONANTS[sc]))])


def render(kind: str, mention: str, surrogate: str) -> str:
    """A surrogate in the format of the mention: its punctuation and its case."""
    if kind in ("card", "ssn", "phone", "iban"):
        it = iter([c for c in surrogate if c.isalnum()])
        return "".join([next(it, "") if c.isalnum() else c for c in mention] + list(it))
    letters = [c for c in mention if c.isalpha()]
    if kind != "secret" and letters and all(c.isupper() for c in letters) and (len(letters) > 1 or kind == "mail"):
        return (surrogate.replace("'", "’") if "’" in mention else surrogate).upper()
    if kind.startswith("given") or kind in ("surname", "initial"):
        word = "".join(c.upper() if i == 0 or surrogate[i - 1] == "'" else c for i, c in enumerate(surrogate))
        return word.replace("'", "’") if "’" in mention else word
    if kind == "mail" and mention[:1].isupper():
        return surrogate[0].upper() + surrogate[1:]
    return surrogate


def rewrite(text: str, table: dict[tuple[str, str], str]) -> tuple[str, list[dict]]:
    out, at, found = [], 0, []
    size = 0
    for a, e, kind, entity in mentions(text):
        new = render(kind, text[a:e], table[kind, entity])
        out += [text[at:a], new]
        size += a - at
        found.append({"type": kind, "start": size, "end": size + len(new)})
        size += len(new)
        at = e
    return "".join([*out, text[at:]]), found


# ---------------------------------------------------------------- on DataFrames

def _mention_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct entities of each text."""
    for b in slices(batches, "text", SLICE):
        rows, kinds, entities = [], [], []
        for i, t in enumerate(b.column("text").to_pylist()):
            for kind, entity in sorted({(k, x) for _, _, k, x in mentions(t)}):
                rows.append(i)
                kinds.append(kind)
                entities.append(entity)
        pick = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("id").take(pick), b.column("h").take(pick), pa.array(kinds, pa.string()),
                                          pa.array(entities, pa.string())], names=["id", "h", "type", "entity"])


def surrogate_map(entities: DataFrame, key: bytes, scratch: Scratch) -> DataFrame:
    """(type, entity, surrogate), one-to-one and disjoint from the entities, of distinct (type, entity).

    Parts of names share one space, any other type has its own.
    """
    space = F.when(F.col("type").startswith("given_") | (F.col("type") == "surname"), F.lit("name")).otherwise(F.col("type"))

    def tries(trial: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = [draw(key, k, e, trial) for k, e in zip(b.column("type").to_pylist(), b.column("entity").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("type"), b.column("entity"), pa.array(got, pa.string())],
                                                 names=["type", "entity", "surrogate"])
        return work

    open_ = entities
    done: DataFrame | None = None
    real = entities.select(space.alias("space"), F.col("entity").alias("surrogate"))
    for trial in range(ROUNDS):
        drawn = open_.mapInArrow(tries(trial), "type string, entity string, surrogate string")
        taken = real if done is None else real.unionByName(done.select(space.alias("space"), "surrogate"))
        first = F.min(F.struct(F.xxhash64("entity").alias("h"), F.col("type").alias("type"), F.col("entity").alias("entity")))
        drawn = scratch.put(drawn.withColumn("space", space))
        won = (drawn.groupBy("space", "surrogate").agg(first.alias("w"))
               .join(taken.hint("merge"), ["space", "surrogate"], "left_anti")
               .select("w.type", "w.entity", "surrogate"))
        won = scratch.put(won)
        done = won if done is None else done.unionByName(won)
        open_ = scratch.put(drawn.select("type", "entity").join(won.select("type", "entity").hint("merge"),
                                                                ["type", "entity"], "left_anti"))
        if open_.isEmpty():
            return done
    raise RuntimeError("more entities of a type and format than surrogates of that format")


def pii_surrogate(df: DataFrame, key: bytes, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The input with surrogates in the text, ``n_entities`` and ``entities`` (type, start, end in the new text)."""
    scratch = Scratch(df.sparkSession, "pii")
    names = [c for c in df.columns if c not in ("n_entities", "entities")]
    rest = [c for c in names if c != text_col]
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(f"`{id_col}`").alias("id"),
                    F.xxhash64(F.col(f"`{text_col}`")).alias("h"), F.col(f"`{text_col}`").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    trace = has_trace(F.col("text"))
    found = scratch.put(src.where(trace).select("id", "h", "text").mapInArrow(
        _mention_rows, f"id {id_type}, h long, type string, entity string").distinct())
    known = surrogate_map(scratch.put(found.select("type", "entity").distinct()), key, scratch)
    # an entity may be in a third of all texts: salt its mentions, repeat its one map row
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id", "h"), F.lit(SALT)))
    spread = known.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALT)])))
    tables = (salted.join(spread.hint("merge"), ["type", "entity", "salt"])
              .groupBy(F.col("id").alias("wid"), F.col("h").alias("wh"))
              .agg(F.collect_list(F.struct("type", "entity", "surrogate")).alias("table")))
    same = F.col("id").eqNullSafe(F.col("wid")) & (F.col("h") == F.col("wh"))
    hit = src.where(trace).join(tables.hint("merge"), same, "left").drop("wid", "wh", "id", "h")
    entity = StructType([StructField("type", StringType()), StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([src.schema["row"], StructField("text", StringType()), StructField("entities", ArrayType(entity))])
    kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            texts, lists = [], []
            for t, table in zip(b.column("text").to_pylist(), b.column("table").to_pylist()):
                new, ents = rewrite(t, {(x["type"], x["entity"]): x["surrogate"] for x in table or []})
                texts.append(new)
                lists.append(ents)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), pa.array(lists, kind)],
                                             names=["row", "text", "entities"])

    changed = hit.select("row", "text", "table").mapInArrow(work, schema)
    clean = src.where(~trace).select("row", "text", F.array().cast(ArrayType(entity)).alias("entities"))
    return changed.unionByName(clean).select(
        *[F.col(f"row.`{c}`").alias(c) if c != text_col else F.col("text").alias(c) for c in names],
        F.size("entities").cast("long").alias("n_entities"), "entities")
