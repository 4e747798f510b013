"""Private data replaced by surrogates of the same type, gender, script and format.

An entity is a kind and a normal form, so that its mentions agree wherever they stand. Its surrogate comes from a keyed
hash; surrogates that meet each other or a real entity of their kind are drawn again until none does. Each mention then
takes the surrogate in its own format: separators, capitals and digit groups stay.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.llm.common import slices
from statlab.session import stage

#: A surrogate grows by a character after so many attempts, so that small spaces do not run out.
GROWS = 4
FEMALE, MALE, EITHER = "f", "m", "e"

# Titles that are followed by a name, and the gender they tell.
TITLES = {
    "Mr": MALE, "Mister": MALE, "Mrs": FEMALE, "Ms": FEMALE, "Miss": FEMALE, "Herr": MALE, "Herrn": MALE, "Frau": FEMALE,
    "Monsieur": MALE, "Madame": FEMALE, "Mme": FEMALE, "Mlle": FEMALE, "Señor": MALE, "Señora": FEMALE, "Sra": FEMALE,
    "Signor": MALE, "Signora": FEMALE, "Dr": EITHER, "Prof": EITHER, "Господин": MALE, "Госпожа": FEMALE, "Κύριος": MALE,
    "Κυρία": FEMALE,
}
# Syllables and endings of made-up names per script.
SYLLABLES = {
    "LATIN": "ba be bo da de do fa fe fi ga ge go ha he ka ke ko la le lo ma me mi mo na ne no pa pe ra re ro sa se so ta te to va ve vi".split(),
    "CYRILLIC": "ба бе бо ва ве ви га го да де до за зе ка ко ла ле ло ма ме ми мо на не но па пе ра ре ро са се со та те то".split(),
    "GREEK": "βα βε γα γε δα δε ζα κα κε λα λε μα με μι να νε νο πα πε ρα ρε ρο σα σε τα τε το φα χα".split(),
}
ENDINGS = {
    "LATIN": {MALE: ["n", "rt", "us", "k"], FEMALE: ["na", "ria", "lia", "ta"], EITHER: ["r", "l", "st", "nd"]},
    "CYRILLIC": {MALE: ["н", "р", "м", "с"], FEMALE: ["на", "рия", "ла", "та"], EITHER: ["ко", "нк", "рт", "ль"]},
    "GREEK": {MALE: ["ς", "ος", "ης"], FEMALE: ["να", "ρία", "λη"], EITHER: ["ου", "κη", "δου"]},
}

EMAIL = regex.compile(r"(?:\G|(?<![\p{L}\p{N}._%+\-]))[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)+")
SECRET = re.compile(r"(?<![A-Za-z0-9_\-])(?=[A-Za-z_\-]*\d)(?=[\d_\-]*[A-Za-z])[A-Za-z0-9_\-]{24,}(?![A-Za-z0-9_\-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
ADDRESS = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)")
NUMBER = re.compile(r"(?<![\w+])(?:\d{3}-\d{2}-\d{4}|\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\w)")
PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{1,4}\)[ .\-]?)?\d{2,5}(?:[ .\-]\d{2,8}){1,4}(?!\w)|(?<![\w.])\+\d{7,15}(?!\w)")
DATE = re.compile(r"\d{4}[.\-]\d{1,2}[.\-]\d{1,2}|\d{1,2}[.\-]\d{1,2}[.\-](?:\d{4}|\d{2})")
NAME = regex.compile(
    r"(?<!\p{L})(?P<title>" + "|".join(sorted(TITLES, key=len, reverse=True))
    + r")\.?[  ](?P<one>\p{Lu}[\p{L}'’\-]+)(?:[  ](?P<two>\p{Lu}[\p{L}'’\-]+))?")
HINT = regex.compile(r"[\d@]|" + "|".join(sorted(TITLES, key=len, reverse=True)))

Found = tuple[int, int, str, str]


def script(word: str) -> str:
    return unicodedata.name(word[0], "LATIN").split(" ")[0]


def _digits(text: str) -> str:
    return "".join(str(unicodedata.digit(c)) for c in text if c.isdigit())


def _names(text: str) -> Iterator[Found]:
    """Names after a title, and every other whole-word mention of them in the text."""
    words: dict[str, str] = {}
    for m in NAME.finditer(text):
        gender = TITLES[m["title"]]
        if m["two"]:
            words.setdefault(m["two"], f"surname {script(m['two'])}")
            kind = f"given {gender} {script(m['one'])}"
            if words.get(m["one"], "given e").startswith("given e"):
                words[m["one"]] = kind
        else:
            words.setdefault(m["one"], f"surname {script(m['one'])}")
    if words:
        kinds = {w.casefold(): kind for w, kind in words.items()}
        forms = sorted({f for w in words for f in (w, w.upper())}, key=len, reverse=True)
        mentions = regex.compile(r"(?<![\p{L}\p{N}])(?:" + "|".join(map(regex.escape, forms)) + r")(?![\p{L}\p{N}])")
        for m in mentions.finditer(text):
            yield m.start(), m.end(), kinds[m[0].casefold()], m[0].casefold()


def detect(text: str | None) -> list[Found]:
    """Start, end, kind and normal form of the private entities in a whole text, in order and never overlapping."""
    if not text or not HINT.search(text):
        return []
    found: list[Found] = []
    rest = text
    for kind, pattern, norm in PATTERNS:  # in order of precedence; what was found is blanked out for the kinds below
        own = [(m.start(), m.end(), kind, n) for m in pattern.finditer(rest) if (n := norm(m[0])) is not None]
        found += own
        parts, at = [], 0
        for start, end, _, _ in own:
            parts += [rest[at:start], "\0" * (end - start)]
            at = end
        rest = "".join([*parts, rest[at:]])
    return sorted(found + list(_names(rest)))


def _phone(mention: str) -> str | None:
    digits = _digits(mention)
    return digits if 7 <= len(digits) <= 15 and not DATE.fullmatch(mention) else None


def _iban(mention: str) -> str | None:
    plain = mention.replace(" ", "")
    return plain if _iban_rest(plain) == 1 else None


def _address(mention: str) -> str | None:
    return mention if all(int(x) < 256 for x in mention.split(".")) else None


PATTERNS = [
    ("email", EMAIL, str.lower), ("iban", IBAN, _iban), ("secret", SECRET, str), ("address", ADDRESS, _address),
    ("number", NUMBER, _digits), ("phone", PHONE, _phone),
]


# --- surrogates


def _iban_rest(iban: str) -> int:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


class Stream:
    """Numbers from a keyed hash of an entity and the number of the attempt."""

    def __init__(self, key: bytes, kind: str, norm: str, attempt: int):
        self.key, self.label, self.block, self.held = key, f"{kind}\0{norm}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.held) < 4:
            self.held += hmac.new(self.key, self.label + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        value, self.held = int.from_bytes(self.held[:4], "big"), self.held[4:]
        return value % n

    def pick(self, values):
        return values[self.below(len(values))]


def _alike(text: str, draw: Stream, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    """Another text of the same pattern: digits for digits, letters for letters, the rest as it is."""
    made = []
    for c in text:
        if c.isdigit():
            made.append(str(draw.below(10)))
        elif c.isalpha():
            new = draw.pick(letters)
            made.append(new.upper() if c.isupper() else new)
        else:
            made.append(c)
    return "".join(made)


def surrogate(key: bytes, kind: str, norm: str, attempt: int) -> str:
    """The normal form of an entity's surrogate: the same kind, length and check digits, and for names script and gender.

    From the fifth attempt on it is longer, or an address of any network, since there may be no free one of its length.
    """
    draw, more = Stream(key, kind, norm, attempt), attempt // GROWS
    if kind == "email":
        local, _, domain = norm.partition("@")
        labels = domain.split(".")
        return _alike(local + "a" * more, draw) + "@" + ".".join([*(_alike(x, draw) for x in labels[:-1]), labels[-1]])
    if kind == "secret":
        hexadecimal = all(c.lower() in "abcdef" for c in norm if c.isalpha())
        return _alike(norm + "a" * more, draw, "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz")
    if kind == "iban":
        rest = "".join(str(draw.below(10)) if c.isdigit() else draw.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in norm[4:] + "0" * more)
        return f"{norm[:2]}{98 - _iban_rest(norm[:2] + '00' + rest):02d}{rest}"
    if kind == "address":
        octets = norm.split(".")
        kept = 0 if more else 1 if octets[0] in ("10", "127") else 2 if octets[:2] == ["192", "168"] else 0
        return ".".join([*octets[:kept], *(str(1 + draw.below(254)) for _ in octets[kept:])])
    if kind in ("number", "phone"):
        made = norm[0] + "".join(str(draw.below(10)) for _ in norm[1:] + "0" * more)
        if kind == "number" and len(norm) > 9 and _luhn(norm) == 0:
            made = next(made[:-1] + d for d in "0123456789" if _luhn(made[:-1] + d) == 0)
        return made
    gender, _, of = kind.removeprefix("given ").removeprefix("surname ").rpartition(" ")
    if of not in SYLLABLES:
        near = [chr(c) for c in range(ord(norm[0]) & ~0x3F, (ord(norm[0]) & ~0x3F) + 64) if chr(c).isalpha()]
        return "".join(draw.pick(near) for _ in range(len(norm) + attempt // 8))
    parts = [draw.pick(SYLLABLES[of]) for _ in range(max(1, min(4, len(norm) // 3)) + attempt // 8)]
    return "".join(parts) + draw.pick(ENDINGS[of][gender or EITHER])


def fitted(mention: str, kind: str, made: str) -> str:
    """A surrogate in the format of one mention."""
    if kind in ("number", "phone", "iban"):
        rest = iter(made)
        taken = [next(rest) if (c != " " if kind == "iban" else c.isdigit()) else c for c in mention]
        return "".join([*taken, *rest])
    if kind.startswith(("given", "surname")):
        return made.upper() if mention.isupper() and len(mention) > 1 else made[:1].upper() + made[1:]
    if kind == "email":
        pairs = zip(mention.split("@"), made.split("@"))
        return "@".join("".join(n.upper() if c.isupper() else n for c, n in zip(old.ljust(len(new)), new)) for old, new in pairs)
    return made


# --- the job


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [(key, *f) for key, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist()) for f in detect(text)]
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["_row", "start", "stop", "kind", "norm"])


def _having(some: bool):
    """Only the rows with, or without, private entities."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([bool(detect(t)) == some for t in batch.column("text").to_pylist()]))
    return made


def _drawn(key: bytes):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, norms, attempts = (batch.column(c).to_pylist() for c in ("kind", "norm", "attempt"))
            drawn = [surrogate(key, k, n, a) for k, n, a in zip(kinds, norms, attempts)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "norm", "attempt")), pa.array(drawn, pa.string())], ["kind", "norm", "attempt", "made"])
    return made


def assign_surrogates(entities: DataFrame, key: str, draw=None) -> DataFrame:
    """``kind, norm, made`` for the distinct entities ``kind, norm``: no two of a kind share a surrogate, and none is real.

    All are drawn; of those that meet, the one drawn first keeps it (on a tie the smaller normal form) and the others
    are drawn again with the next attempt, as are those that are some entity's normal form. Surrogates grow with the attempts,
    so this ends (for addresses, unless nearly all that there can be are in the texts). One row comes to the driver a round. ``draw`` replaces the drawing function, for tests.
    """
    schema = "kind string, norm string, attempt int, made string"
    draw = draw or _drawn(key.encode())
    real = stage(entities.select("kind", "norm").distinct(), "entities")
    taken = real.select("kind", F.col("norm").alias("made"))
    settled = stage(real.withColumn("attempt", F.lit(0)).mapInArrow(draw, schema), "drawn")
    while True:
        first = settled.groupBy("kind", "made").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n"))
        crowded = stage(first.where("n > 1").select("kind", "made", "first"), "crowded")
        judged = settled.join(crowded, ["kind", "made"], "left")
        judged = judged.join(taken.withColumn("real", F.lit(True)), ["kind", "made"], "left")
        again = F.col("real").isNotNull() | F.coalesce(F.struct("attempt", "norm") != F.col("first"), F.lit(False))
        judged = stage(judged.select("kind", "norm", "attempt", "made", again.alias("again")), "judged")
        left = judged.where("again")
        if not left.head(1):
            return judged.select("kind", "norm", "made")
        redrawn = left.select("kind", "norm", (F.col("attempt") + 1).alias("attempt")).mapInArrow(draw, schema)
        settled = stage(judged.where("NOT again").drop("again").unionByName(redrawn), "drawn")


def _replaced(names: list[str]):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, counts = [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist()):
                parts, at = [], 0
                for s in sorted(spans, key=lambda x: x["start"]):
                    parts += [text[at:s["start"]], fitted(text[s["start"]:s["stop"]], s["kind"], s["made"])]
                    at = s["stop"]
                texts.append("".join([*parts, text[at:]]))
                counts.append(len(spans))
            own = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(counts, pa.int32())], [*names, "n_entities"])
    return made


def replace_private(docs: DataFrame, key: str = "statlab") -> DataFrame:
    """``docs`` with private entities replaced in ``text``, and ``n_entities``, the number of mentions replaced.

    One entity has one surrogate in all documents, so mentions go on to agree; two entities never share one. The
    mapping is kept nowhere but in the shared folder of the run, and depends on ``key``. Only texts with entities
    travel; all others are passed through where they are. A null or empty text stays as it is with 0. A column
    ``n_entities`` of the input is replaced.
    """
    own = docs.drop("n_entities", "_row", "_spans")
    names, schema = own.columns, ", ".join(f"`{c}` {t}" for c, t in own.dtypes)
    row = F.xxhash64("text").alias("_row")
    found = stage(own.select(row, "text").mapInArrow(_mentions, "_row long, start int, stop int, kind string, norm string").distinct(), "mentions")
    mapping = assign_surrogates(found, key)
    spans = found.join(mapping, ["kind", "norm"]).groupBy("_row").agg(F.collect_list(F.struct("start", "stop", "kind", "made")).alias("_spans"))
    touched = own.mapInArrow(_having(True), schema).withColumn("_row", F.xxhash64("text")).join(stage(spans, "spans"), "_row")
    changed = touched.select(*names, "_spans").mapInArrow(_replaced(names), f"{schema}, n_entities int")
    return own.mapInArrow(_having(False), schema).withColumn("n_entities", F.lit(0)).unionByName(changed)


def pii_surrogates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_entities, text`` of every document."""
    return replace_private(docs.select("doc_id", "text")).select("doc_id", "n_entities", "text")
