"""PII surrogates: detected entities get keyed, type-consistent replacements.

Kinds: e-mail, phone, IP address (4 and 6, compressed too), payment card, IBAN, US social security number, secret (keys and tokens) and
person (a name after a title or an introduction, or before a Chinese title, and every further place of that full name in the
text). An entity's canonical form (case, separators and title taken off)
decides the replacement, so it is the same wherever the entity occurs (coreference). Formats stay: digits
replace digits and letters letters of the same case and script at the same places, separators,
country code, card and IBAN checksum are kept; IP numbers stay private or public; e-mails keep shape and case of the local part and get a reserved
domain; names keep gender, script and capitals.

A person's name is replaced part by part: first names by gender (of any title that the name has in the text, else of its
ending), last names without. So a last name alone, a full name and the same name with another title agree.

Distinctness. Replacements are drawn with a keyed hash and an attempt number. All distinct entities (names: their parts)
of the corpus are gathered as (kind, canonical form) with a shuffle; a replacement that two entities share, or that is itself an
entity, stays with who has it (the smallest if several draw it at once), the others draw again with the next attempt, until no
two are equal; from attempt ATTEMPTS on replacements are longer, so that they do not run out. Only these redrawn entities differ from attempt 0; they are sent to the rewriting pass as a
broadcast table of up to BLOCK rows; more are joined to the rows that mention them.

Defined results: null text stays null, empty text stays empty; text without entities is returned as it is; very long texts are scanned
whole; repeated rows get equal texts; where two kinds match at one place, the one named first wins; an empty table gives no rows; further columns are
kept whatever their names, but one with the name asked for the count is replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import string
import unicodedata
from functools import lru_cache
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.columns import private
from gneiss.session import checkpoint, materialize, table

KEY = b"gneiss-surrogates"
BLOCK = 50_000
ATTEMPTS = 16

#: Titles that announce a person, by gender.
MALE = ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "Doña", "Г-жа", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Prof", "Mx")
INTRODUCTIONS = ("my name is", "I am called", "mein Name ist", "je m'appelle", "me llamo", "mi nombre es", "меня зовут")
#: Syllables that surrogate names are made of, and their endings by gender.
SYLLABLES = {
    "latin": ("ba be bo da de di do fa fe ga ge ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi".split(), {"m": ("n", "r", "s"), "f": ("a", "ia", "ina"), "": ("l", "m", "t")}),
    "cyrillic": ("ба бе бо да де ди до га ка ки ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се си со та те ти то ва ве ви".split(), {"m": ("в", "н", "р"), "f": ("а", "ина", "ия"), "": ("к", "м", "ль")}),
    "greek": ("βα βε γα γε δα δε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σε σι τα τε τι".split(), {"m": ("ος", "ης", "ας"), "f": ("α", "η", "ια"), "": ("ι", "ου", "ων")}),
    "han": (list("安白成德方高光海江金康李林明南平青仁山松天王文武新星杨永玉张"), {"m": ("刚", "强", "军"), "f": ("芳", "娟", "丽"), "": ("宁", "文", "晨")}),
}

#: Frequent Chinese last names, and titles by gender.
_han = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤"
HAN_TITLES = {"先生": "m", "女士": "f", "小姐": "f", "太太": "f"}

_titles = "|".join(re.escape(t) for t in sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
_intro = "|".join(re.escape(t) for t in INTRODUCTIONS)
_name = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][\w'’-]*[^\W\d_]"
_octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: One scan finds all kinds; at one place the earlier alternative wins.
ENTITY = re.compile(
    "|".join(
        (
            r"(?P<email>[\w.!#$%&'*+/=?^`{|}~-]*[\w+-]@(?:[\w-]+\.)+[^\W\d_]{2,})",
            r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b)",
            r"(?P<secret>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:gh[pousr]_|sk-|xox[abp]-)[A-Za-z0-9_-]{16,}|\b(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,128}\b)",
            r"(?P<secret2>(?:(?<=token = \")|(?<=token=\")|(?<=key = \")|(?<=key=\")|(?<=secret = \")|(?<=password = \")|(?<=password=\"))[^\"\s]{8,})",
            r"(?P<ipv6>(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:){2,7}:)(?![\w:]))",
            rf"(?P<ip>(?<![\w.]){_octet}(?:\.{_octet}){{3}}(?!\w|\.\d))",
            r"(?P<phone>(?<!\w)\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])|(?<![\w.+/-])(?:(?:\(0\d{1,4}\) ?|0\d{1,4}[ /-])\d{6,8}|0\d{1,4}(?P<s3>[ -])\d{2,4}(?:(?P=s3)\d{2,4}){2,4})(?![\w-]))",
            r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
            r"(?P<card>(?<![\w.-])(?:\d{4}(?P<s1>[ -]?)\d{4}(?P=s1)\d{4}(?P=s1)\d{1,7}|3\d{3}(?P<s2>[ -]?)\d{6}(?P=s2)\d{5})(?![\w-]))",
            rf"(?P<han>(?:(?<=我叫)|(?<=我的名字是)|(?<=我的名字叫))(?:[{_han}][一-鿿]{{1,2}})|[{_han}][一-鿿]{{0,2}}(?=先生|女士|小姐|太太|博士|教授))",
            rf"(?P<person>(?:\b(?P<title>{_titles})\.? |\b(?:{_intro}) )(?P<name>{_name}(?: {_name}){{0,2}}))",
        )
    )
)
#: A text without any of these characters in a row needs no scan for anything but names.
HINT = re.compile(r"@|\d[\d .()-]{6}|[0-9a-fA-F]{16}|AKIA|ASIA|gh[pousr]_|sk-|xox|(?:token|key|secret|password) ?= ?\"|\.\d{1,3}\.|:[0-9A-Fa-f]{1,4}:|::|\b0\d+[ )/-]")
NAMED = re.compile(rf"\b(?:{_titles})\.? [^\W\d_]|\b(?:{_intro}) |我叫|我的名字|先生|女士|小姐|太太|博士|教授")


class _Draw:
    """A stream of numbers that key, kind, entity and attempt decide."""

    def __init__(self, kind: str, entity: str, attempt: int, key: bytes):
        self.seed, self.pool, self.at, self.block = f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass"), b"", 0, 0
        self.key = key

    def below(self, n: int) -> int:
        if self.at + 4 > len(self.pool):
            self.pool, self.at = hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest(), 0
            self.block += 1
        self.at += 4
        return int.from_bytes(self.pool[self.at - 4 : self.at], "big") % n


def luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10


@lru_cache(4096)
def _alike(block: int, category: str) -> str:
    """The letters of a block of 128 code points that have a category."""
    return "".join(c for c in map(chr, range(block * 128, block * 128 + 128)) if unicodedata.category(c) == category)


def _drawn(c: str, draw: _Draw) -> str:
    """A digit for a digit, and a letter of the same script and case for a letter."""
    if "0" <= c <= "9":
        return str(draw.below(10))
    if "a" <= c <= "z":
        return string.ascii_lowercase[draw.below(26)]
    if "A" <= c <= "Z":
        return string.ascii_uppercase[draw.below(26)]
    category = unicodedata.category(c)
    if category[0] == "L" or category == "Nd":
        held = _alike(ord(c) // 128, category)
        return held[draw.below(len(held))]
    return c


def _shape(text: str, draw: _Draw, keep: int = 0) -> str:
    """Digits and letters of the same kind at the same places; the first `keep` characters stay."""
    return text[:keep] + "".join(_drawn(c, draw) for c in text[keep:])


def _script(word: str) -> str:
    c = next((x for x in word if x.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "han" if "一" <= c <= "鿿" else "latin"


def ending(name: str) -> str:
    """The gender that a name's first part tells by its ending."""
    return "f" if name.split(" ")[0].lower().endswith(("a", "ia", "ie", "а", "я", "α", "η")) else "m"


def titled(title: str | None) -> str:
    return "m" if title in MALE else "f" if title in FEMALE else HAN_TITLES.get(title or "", "")


def canonical(kind: str, text: str) -> str:
    """What two mentions of one entity share."""
    if kind == "ipv6":
        return ipaddress.IPv6Address(text).exploded
    if kind == "email":
        return text.lower()
    if kind in ("phone", "card", "ssn"):
        return "+" * text.startswith("+") + "".join(str(unicodedata.digit(c)) for c in text if c.isdigit())
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "name":
        return text.casefold()
    return text


def _cased(made: str, like: str) -> str:
    return made.upper() if len(like) > 1 and like.isupper() else made.capitalize() if like[:1].isupper() else made


def _iban_rest(iban: str) -> int:
    """What the checksum of an IBAN leaves; 1 if it is right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


#: Country codes of phones of one and two digits; the others have three.
COUNTRIES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _country(phone: str) -> int:
    """The length of the country code of +digits, or of the 0 of a national number."""
    if not phone.startswith("+"):
        return int(phone.startswith("0"))
    return next((n for n in (1, 2) if phone[1 : 1 + n] in COUNTRIES), 3)


#: Private networks of IP version 4, by their first numbers.
PRIVATE = ((10,), (127,), (192, 168), *((172, k) for k in range(16, 32)))


def _ip(text: str, draw: _Draw) -> str:
    parts = tuple(map(int, text.split(".")))
    for held in PRIVATE:
        if parts[: len(held)] == held:
            return ".".join(map(str, held + tuple(draw.below(256) for _ in parts[len(held) :])))
    while True:
        made = (1 + draw.below(223), *(draw.below(256) for _ in range(3)))
        if not any(made[: len(held)] == held for held in PRIVATE):
            return ".".join(map(str, made))


def _part(text: str, role: str, attempt: int, key: bytes) -> str:
    """A part of a name; role: gender of a first name, or last."""
    own = _Draw("name", f"{canonical('name', text)}\0{role}", attempt, key)
    syllables, ends = SYLLABLES[_script(text)]
    n = (2 if _script(text) == "han" else 3 + own.below(2)) + 2 * (attempt >= ATTEMPTS)
    return _cased("".join(syllables[own.below(len(syllables))] for _ in range(n)) + ends["" if role == "last" else role][own.below(3)], text)


def parts(text: str, sex: str) -> list[tuple[str, str]]:
    """(part, role) of a name as it is mentioned: the last of several parts, or a part alone behind a title (sex is ''), is a last name."""
    held = text.split(" ")
    return [(p, "last" if not sex or i and i == len(held) - 1 else sex) for i, p in enumerate(held)]


def entities(kind: str, text: str, sex: str) -> list[tuple[str, str]]:
    """(kind, canonical form) of what a mention is replaced by."""
    if kind == "person":
        return [("name", f"{canonical('name', p)}\0{role}") for p, role in parts(text, sex)]
    return [(kind, canonical(kind, text))]


def surrogate(kind: str, text: str, attempt: int = 0, key: bytes = KEY) -> str:
    """The replacement of a mention: decided by the canonical form, laid out like the mention."""
    entity = canonical(kind, text)
    draw = _Draw(kind, entity, attempt, key)
    more = f"-{draw.below(1_000_000):06d}" if attempt >= ATTEMPTS else ""
    if kind == "email":
        made = _shape(entity.rpartition("@")[0], draw)
        made = "".join(m.upper() if c.isupper() and len(m.upper()) == 1 else m for m, c in zip(made, text)) if len(text) == len(entity) else made
        tag = "".join("0123456789abcdefghjkmnpqrstvwxyz"[draw.below(32)] for _ in range(10))
        return f"{made}.{tag}{more}@example.net"
    if kind in ("phone", "ssn", "card"):
        # the country code, or the 0 for it, of a phone stays; a card's checksum is as right as before
        stay, entity = _country(entity) if kind == "phone" else 0, entity.lstrip("+")
        digits = list(entity[:stay]) + [str(draw.below(10)) for _ in entity[stay:]]
        if kind == "card":
            digits[0] = entity[0]
            if luhn(entity) == 0:
                digits[-1] = "0"
                digits[-1] = str(-luhn("".join(digits)) % 10)
        left = iter(digits)
        return "".join(next(left) if c.isdigit() else c for c in text) + more
    if kind == "ip":
        return _ip(text, draw) if attempt < ATTEMPTS else f"{_ip(text, draw)}:{1024 + draw.below(60_000)}"
    if kind == "ipv6":
        groups = [0 if int(g, 16) == 0 else 1 + draw.below(0xFFFF) for g in entity.split(":")]
        made = ipaddress.IPv6Address(sum(g << 16 * (7 - i) for i, g in enumerate(groups)))
        return made.compressed if "::" in text else made.exploded
    if kind == "iban":
        made = entity[:2] + _shape(entity[2:], draw)
        if _iban_rest(entity) == 1:
            made = made[:2] + f"{98 - _iban_rest(made[:2] + '00' + made[4:]):02d}" + made[4:]
        left = iter(made)
        return "".join(c if c == " " else next(left) for c in text) + more.replace("-", " ")
    prefix = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abp]-", text)
    if re.fullmatch(r"[0-9a-fA-F]{32,}", text):
        letters = "0123456789ABCDEF" if text.upper() == text else "0123456789abcdef"
        return "".join(letters[draw.below(16)] for _ in text)
    return _shape(text, draw, len(prefix.group()) if prefix else 0) + more


def mentions(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, gender) of each entity, left to right; the gender of a last name alone is ''."""
    if not text or not (HINT.search(text) or NAMED.search(text)):
        return []
    out, sexes = [], {}
    for found in ENTITY.finditer(text):
        kind = next(k for k in ("email", "iban", "secret", "secret2", "ipv6", "ip", "phone", "ssn", "card", "han", "person") if found.group(k) is not None)
        if kind == "ipv6":
            try:
                ipaddress.IPv6Address(found.group())
            except ValueError:
                continue
        if kind in ("han", "person"):
            start, end = found.span("name") if kind == "person" else found.span()
            title = found.group("title") if kind == "person" else text[end : end + 2]
            name, told = text[start:end], titled(title)
            alone = " " not in name and (bool(title) if kind == "person" else title in HAN_TITLES or title in ("博士", "教授"))
            if told:
                sexes.setdefault(name.casefold(), told)
            out.append(("person", start, end, "" if alone else "?"))
        else:
            out.append(("secret" if kind == "secret2" else kind, *found.span(), ""))
    full = {text[s:e] for k, s, e, sex in out if k == "person" and sex and " " in text[s:e]}
    if full:
        taken = {s for _, s, _, _ in out}
        again = re.compile("|".join(rf"(?<!\w){re.escape(n)}(?!\w)" for n in sorted(full, key=lambda n: (-len(n), n))))
        spans = sorted((s, e) for _, s, e, _ in out)
        free = [m.span() for m in again.finditer(text) if m.start() not in taken]
        out = sorted(out + [("person", s, e, "?") for s, e in free if not any(s < b and a < e for a, b in spans)], key=lambda m: m[1])
    return [(k, s, e, sex and (sexes.get(text[s:e].casefold()) or ending(text[s:e]))) if k == "person" else (k, s, e, sex) for k, s, e, sex in out]


def rewrite(text: str | None, redrawn: dict[tuple[str, str], int], key: bytes = KEY) -> tuple[str | None, int]:
    """(text with surrogates, number of entities). redrawn: (kind, canonical form) to its attempt."""
    found = mentions(text)
    if not found:
        return text, 0
    out, at = [], 0
    for kind, start, end, sex in found:
        own = text[start:end]
        if kind == "person":
            made = " ".join(_part(p, role, redrawn.get(e, 0), key) for (p, role), e in zip(parts(own, sex), entities(kind, own, sex)))
        else:
            made = surrogate(kind, own, redrawn.get((kind, canonical(kind, own)), 0), key)
        out += [text[at:start], made]
        at = end
    return "".join(out) + text[at:], len(found)


def made_of(kind: str, entity: str, attempt: int, key: bytes) -> str:
    """The canonical form of an entity's draw."""
    if kind == "name":
        part, _, role = entity.partition("\0")
        return canonical("name", _part(part, role, attempt, key))
    return canonical(kind, surrogate(kind, entity, attempt, key)) if attempt < ATTEMPTS else surrogate(kind, entity, attempt, key)


def _distinct(key: bytes):
    """(kind, entity, made): the distinct entities of a batch with their first draw, both canonical."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, str], str] = {}
            for text in batch.column(0).to_pylist():
                for kind, start, end, sex in mentions(text):
                    for one in entities(kind, text[start:end], sex):
                        if one not in seen:
                            seen[one] = made_of(*one, 0, key)
            if seen:
                yield pa.RecordBatch.from_pydict({"kind": [k for k, _ in seen], "entity": [e for _, e in seen], "made": list(seen.values())})

    return run


def _again(key: bytes):
    """(kind, entity, made, attempt, redo): those to redo get their next draw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(m, a) if not redo else (made_of(k, e, a + 1, key), a + 1) for k, e, m, a, redo in zip(*(batch.column(i).to_pylist() for i in range(5)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([m for m, _ in rows], pa.string()), pa.array([a for _, a in rows], pa.int32()), batch.column(4)], names=["kind", "entity", "made", "attempt", "fresh"])

    return run


def redraws(docs: DataFrame, text: str = "text", key: bytes = KEY) -> DataFrame:
    """(kind, entity, attempt) of the entities whose first draw was taken."""
    found = docs.select(text).mapInArrow(_distinct(key), "kind string, entity string, made string")
    rows = materialize(found.distinct(), "entities").withColumn("attempt", F.lit(0)).withColumn("fresh", F.lit(False))
    known = rows.select("kind", F.substring_index("entity", "\0", 1).alias("made")).distinct()
    for _ in range(4 * ATTEMPTS):
        held = rows.groupBy("kind", "made").agg(F.min(F.struct("fresh", "entity"))["entity"].alias("holder"), F.count("*").alias("n")).where("n > 1").drop("n")
        shared = rows.join(held, ["kind", "made"]).where("entity <> holder").select("kind", "entity")
        real = rows.join(known, ["kind", "made"], "left_semi").select("kind", "entity")
        taken = checkpoint(shared.unionByName(real).distinct())
        if taken.isEmpty():
            return rows.where("attempt > 0").select("kind", "entity", "attempt")
        marked = rows.join(taken.withColumn("redo", F.lit(True)), ["kind", "entity"], "left")
        marked = marked.select("kind", "entity", "made", "attempt", F.coalesce("redo", F.lit(False)).alias("redo"))
        rows = checkpoint(marked.mapInArrow(_again(key), "kind string, entity string, made string, attempt int, fresh boolean"))
    raise RuntimeError(f"surrogates still collide after {4 * ATTEMPTS} draws")


def replace_pii(docs: DataFrame, text: str = "text", key: bytes = KEY, count: str | None = None, block: int = BLOCK) -> DataFrame:
    """docs with entities replaced in text; count names a column for the number of entities."""
    late = checkpoint(redraws(docs, text, key))
    if late.count() > block:
        return _joined(docs, text, key, count, late)
    held = {(r["kind"], r["entity"]): r["attempt"] for r in late.collect()}
    return _rewritten(docs, text, key, count, held)


def _finished(out: DataFrame, done: str, text: str, count: str | None, *gone: str) -> DataFrame:
    out = out.withColumn(text, F.col(done)["text"])
    return (out.withColumn(count, F.col(done)["n"]) if count else out).drop(done, *gone)


def _rewritten(docs: DataFrame, text: str, key: bytes, count: str | None, held: dict) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(held)

    @F.pandas_udf("text string, n long")
    def run(texts):
        import pandas as pd

        made = [rewrite(t, shared.value, key) for t in texts]
        return pd.DataFrame({"text": [d[0] for d in made], "n": [d[1] for d in made]})

    (done,) = private(docs, "done")
    return _finished(docs.withColumn(done, run(F.col(text))), done, text, count)


def _joined(docs: DataFrame, text: str, key: bytes, count: str | None, late: DataFrame) -> DataFrame:
    """With many redrawn entities: each row gets the attempts of its own entities by a join."""
    done, row, own = private(docs, "done", "row", "own")
    placed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "placed")

    @F.pandas_udf("array<struct<kind:string,entity:string>>")
    def names(texts):
        return texts.map(lambda t: [{"kind": k, "entity": e} for k, e in dict.fromkeys(x for k, s, e, sex in mentions(t) for x in entities(k, t[s:e], sex))], na_action="ignore")

    mine = placed.select(F.col(row).alias("r"), F.explode(names(F.col(text))).alias("m")).select("r", "m.kind", "m.entity")
    held = mine.join(late, ["kind", "entity"]).groupBy("r").agg(F.to_json(F.collect_list(F.array("kind", "entity", F.col("attempt").cast("string")))).alias(own))
    held = held.withColumnRenamed("r", row)

    @F.pandas_udf("text string, n long")
    def run(texts, listed):
        import json

        import pandas as pd

        made = [rewrite(t, {(k, e): int(a) for k, e, a in json.loads(x or "[]")}, key) for t, x in zip(texts, listed)]
        return pd.DataFrame({"text": [d[0] for d in made], "n": [d[1] for d in made]})

    return _finished(placed.join(held, row, "left").withColumn(done, run(F.col(text), F.col(own))), done, text, count, row, own)


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for every detected entity."""
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), count="n_entities")
