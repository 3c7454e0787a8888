"""Generated replacement values (M1-M14) as Column expressions over a hash.

Every generator takes ``h``, the 32-character md5 hex digest of a salted key,
and turns slices of it into indexes into the word lists. The same key always
gives the same value, in every task and on every re-run (executor loss
included), and DuckDB computes the same digests, so oracles can re-derive it.
"""

from __future__ import annotations

import datetime
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .permute import permuted
from .templates import fill_template, parse_template

SEP = "\x1f"  # separator between key parts


def key_hash(salt: str, *parts: Column | str) -> Column:
    """md5 hex of ``salt`` and the key parts (nulls read as empty text)."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(SEP, F.lit(salt), *cols))


def draw32(h: Column, i: int) -> Column:
    """The i-th (0..3) 32-bit unsigned number in the digest."""
    return F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint")


def draw60(h: Column) -> Column:
    """A 60-bit unsigned number from the first 15 hex digits."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def word_array(words: tuple[str, ...]) -> Column:
    """The list as one array literal (``split`` of a literal is constant-folded),
    built with two calls instead of one per word."""
    return F.split(F.lit(SEP.join(words)), SEP)


def pick(words: tuple[str, ...], n: Column) -> Column:
    return F.element_at(word_array(words), (n % len(words) + 1).cast("int"))


def gender_code(gender) -> str | Column | None:
    if gender is None or isinstance(gender, Column):
        return gender
    g = str(gender).strip().lower()
    if g in ("f", "female"):
        return "F"
    if g in ("m", "male"):
        return "M"
    raise ValueError(f"unknown gender {gender!r}")


def first_name(h: Column, gender: Column | str | None = None) -> Column:
    """M1: null gender -> any name; ``F`` -> female; any other value -> male."""
    g = gender_code(gender)
    anyone = pick(vocab.FEMALE_FIRST_NAMES + vocab.MALE_FIRST_NAMES, draw32(h, 0))
    female = pick(vocab.FEMALE_FIRST_NAMES, draw32(h, 0))
    male = pick(vocab.MALE_FIRST_NAMES, draw32(h, 0))
    if g is None:
        return anyone
    if isinstance(g, str):
        return female if g == "F" else male
    return F.when(g.isNull(), anyone).when(g == "F", female).otherwise(male)


def last_name(h: Column, gender: Column | str | None = None) -> Column:
    """M2: surnames are shared by all genders in this locale; gender is accepted."""
    gender_code(gender)
    return pick(vocab.LAST_NAMES, draw32(h, 1))


def date_of_birth(h: Column, start: int = 2000, end: int = 2005) -> Column:
    """M3: a day in ``[start-01-01, end-12-31]`` as ``yyyy-MM-dd HH:mm:ss`` (midnight)."""
    lo = datetime.date(int(start), 1, 1)
    days = (datetime.date(int(end), 12, 31) - lo).days + 1
    return F.date_format(F.date_add(F.lit(lo), (draw60(h) % days).cast("int")), "yyyy-MM-dd HH:mm:ss")


def street_number(h: Column, maximum: int = 1400) -> Column:
    """M4: 1..maximum."""
    return (draw32(h, 2) % int(maximum) + 1).cast("string")


def street_name(h: Column) -> Column:
    return pick(vocab.STREET_NAMES, draw32(h, 3))          # M5


def street_suffix(h: Column) -> Column:
    return pick(vocab.STREET_SUFFIXES, draw32(h, 2))       # M6


def city(h: Column) -> Column:
    return pick(vocab.CITIES, draw32(h, 1))                # M7


def state(h: Column) -> Column:
    return pick(vocab.STATES, draw32(h, 0))                # M8


def zip_code(h: Column) -> Column:
    """M9: four digits."""
    return F.lpad((draw32(h, 3) % 10000).cast("string"), 4, "0")


def email(h: Column, domains: list[str] | None = None) -> Column:
    """``first.last<nn>@domain``; ``domains`` replaces the list of domains."""
    first = pick(vocab.FEMALE_FIRST_NAMES + vocab.MALE_FIRST_NAMES, draw32(h, 0))
    return F.concat(F.lower(first), F.lit("."), F.lower(pick(vocab.LAST_NAMES, draw32(h, 1))),
                    (draw32(h, 2) % 100).cast("string"), F.lit("@"),
                    pick(tuple(d.removeprefix("@") for d in domains or vocab.EMAIL_DOMAINS), draw32(h, 3)))


def phone_number(h: Column, mask: str | None = None) -> Column:
    """Mobile-style ``04dd ddd ddd``, or a number by a template."""
    if mask is not None:
        return template(h, mask)
    d = F.lpad((draw60(h) % 100000000).cast("string"), 8, "0")
    return F.concat(F.lit("04"), F.substring(d, 1, 2), F.lit(" "), F.substring(d, 3, 3),
                    F.lit(" "), F.substring(d, 6, 3))


def contact_details(h: Column, contact_type: Column) -> Column:
    """Type text containing ``email`` -> email, ``phone`` -> phone, else null
    (email tested first, case-insensitive; a null type gives null)."""
    t = F.lower(contact_type)
    return (F.when(F.contains(t, F.lit("email")), email(h))
            .when(F.contains(t, F.lit("phone")), phone_number(h)))


ACCOUNT_START, ACCOUNT_END = 1000000000100000, 1200000000000000


def account_number(h: Column, start: int = ACCOUNT_START, end: int = ACCOUNT_END) -> Column:
    """Integer in ``[start, end]`` as text."""
    return (F.lit(int(start)).cast("bigint") + draw60(h) % (int(end) - int(start) + 1)).cast("string")


def distinct_number(h: Column, value: Column, key: str, start: int = ACCOUNT_START, end: int = ACCOUNT_END) -> Column:
    """An integer in ``[start, end]`` as text, different for different values.

    ``value`` is read as a whole number; numbers of the range itself and those
    from 0 to ``end - start`` are both taken (as their place in the range, so the
    two must not be mixed in one column). Any other value has no number to
    permute: it becomes null, rather than one that another value may have.
    """
    start, size = int(start), int(end) - int(start) + 1
    number = F.when(value.rlike("^[0-9]{1,18}$"), value).try_cast("bigint")
    place = F.when(number >= start, number - start).otherwise(number)
    return (permuted(place, size, key) + F.lit(start).cast("bigint")).cast("string")


def template(h: Column, template: str) -> Column:
    """A value by template (see ``templates``); ``{name}`` is a generator's value."""
    return fill_template(template, h, generate)


def full_name(h: Column, gender: Column | str | None = None, reverse: bool = False) -> Column:
    """First and last name; ``reverse``: ``Last, First``."""
    first, last = first_name(h, gender), last_name(h, gender)
    return F.concat(last, F.lit(", "), first) if reverse else F.concat(first, F.lit(" "), last)


def address(h: Column) -> Column:
    """``<number> <street> <suffix>``."""
    return F.concat_ws(" ", street_number(h), street_name(h), street_suffix(F.md5(h)))


def user_name(h: Column, mask: str = "{firstname}.{lastname}[10-99]") -> Column:
    """A login name by template, in small letters."""
    return F.lower(template(h, mask))


def drivers_license(h: Column) -> Column:
    """Two capital letters and a number 1000..9999."""
    letter = lambda i: F.substring(F.lit(vocab.ALPHABET), (draw32(h, i) % 26 + 1).cast("int"), 1)
    return F.concat(letter(0), letter(1), (draw32(h, 2) % 9000 + 1000).cast("string"))


# Generators by name, with the keyword arguments each accepts.
GENERATORS = {
    "firstname": (first_name, {"gender"}),
    "lastname": (last_name, {"gender"}),
    "date_of_birth": (date_of_birth, {"start", "end"}),
    "street_number": (street_number, {"maximum"}),
    "street_name": (street_name, set()),
    "street_suffix": (street_suffix, set()),
    "city": (city, set()),
    "state": (state, set()),
    "zip_code": (zip_code, set()),
    "email": (email, {"domains"}),
    "phone_number": (phone_number, {"mask"}),
    "contact_details": (contact_details, {"contact_type"}),
    "account_number": (account_number, {"start", "end"}),
    "drivers_license": (drivers_license, set()),
    "distinct_number": (distinct_number, {"start", "end"}),
    "template": (template, {"template"}),
    "full_name": (full_name, {"gender", "reverse"}),
    "address": (address, set()),
    "user_name": (user_name, {"mask"}),
}

# Generators that permute the value itself under a key of the column.
BY_VALUE = frozenset({"distinct_number"})

# Other spellings accepted for a generator name (keyed masking specs).
ALIASES = {
    "first_name": "firstname", "last_name": "lastname", "surname": "lastname",
    "telephone": "phone_number", "phone": "phone_number", "postal_code": "zip_code",
    "postcode": "zip_code", "dob": "date_of_birth", "birthdate": "date_of_birth",
    "fullname": "full_name", "name": "full_name", "username": "user_name",
}


def resolve(name: str) -> str:
    """Generator name for ``name``; a ``provider.`` prefix is ignored."""
    key = str(name).strip().lower().rsplit(".", 1)[-1]
    key = ALIASES.get(key, key)
    if key not in GENERATORS:
        raise ValueError(f"unknown mask function {name!r}")
    return key


def check(name: str, kwargs: dict | None = None) -> str:
    """Validate a generator name and its arguments without building anything."""
    key = resolve(name)
    unknown = set(kwargs or {}) - GENERATORS[key][1]
    if unknown:
        raise ValueError(f"mask function {name!r} takes no argument(s) {sorted(unknown)}")
    kwargs = kwargs or {}
    if "gender" in kwargs:
        gender_code(kwargs["gender"])
    if key == "template" and "template" not in kwargs:
        raise ValueError("mask function 'template' needs a template")
    if "domains" in kwargs and not (kwargs["domains"] and all(isinstance(d, str) and d for d in kwargs["domains"])):
        raise ValueError(f"mask function {name!r} needs a list of domains")
    for text in (kwargs.get("mask"), kwargs.get("template")):
        for part in parse_template(text) if text is not None else ():
            if part.kind == "name" and (inner := check(part.value)) and inner in (*BY_VALUE, "template", "contact_details"):
                raise ValueError(f"template {text!r} cannot hold {part.value!r}")
    return key


def generate(name: str, h: Column, **kwargs) -> Column:
    return GENERATORS[check(name, kwargs)][0](h, **kwargs)


def generate_from(name: str, h: Column, value: Column, key: str, **kwargs) -> Column:
    """``generate``, for the generators that need the value beside its hash too."""
    found = check(name, kwargs)
    return GENERATORS[found][0](h, value, key, **kwargs) if found in BY_VALUE else generate(name, h, **kwargs)


def kwargs_text(kwargs: dict | None) -> str:
    """Canonical text of provider arguments, part of the keyed-mask hash."""
    return json.dumps(kwargs or {}, sort_keys=True, separators=(",", ":"))
