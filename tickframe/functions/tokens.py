"""Expressions on key names, slugs and labels: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickframe.functions import tables as T


def lookup(table: dict, key: Column, default: Column | None = None) -> Column:
    """The table's value of key, or default (null)."""
    found = F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)
    return found if default is None else F.coalesce(found, default)


def literal(raw: Column) -> Column:
    """A key name as keybinds write it: trimmed, lower case, aliases resolved; '' for null."""
    s = F.coalesce(F.lower(F.trim(raw)), F.lit(""))
    return lookup(T.LITERAL_ALIASES, s, s)


def event_key(raw: Column, bound: Column | None = None, aggressive: bool = True) -> Column:
    """A recorded key as a canonical token; null where it is dropped: nothing, control codes, virtual key codes, system keys unless bound."""
    s = F.lower(F.trim(raw))
    token = lookup(T.LITERAL_ALIASES, s, s)
    system = token.isin(T.OS_KEYS + (T.F_KEYS if aggressive else []))
    if bound is not None:
        system = system & ~F.array_contains(bound, token)
    control = (F.char_length(s) == 1) & (F.ascii(s) < 32)
    return F.when(raw.isNull() | (s == "") | control | s.rlike(T.VIRTUAL_KEY) | system, None).otherwise(token)


def is_motion(token: Column) -> Column:
    return token.isin(T.MOTION_LITERALS)


def display(token: Column) -> Column:
    """The name that deliveries show."""
    camel = F.array_join(F.transform(F.split(token, "_"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1000)))), "")
    return lookup(T.KEY_DISPLAY, token, F.when(F.char_length(token) == 1, F.upper(token)).otherwise(camel))


def canonical(shown: Column) -> Column:
    """The inverse of display."""
    back = {v: k for k, v in T.KEY_DISPLAY.items()}
    snake = F.lower(F.regexp_replace(shown, "(?<!^)(?=[A-Z])", "_"))
    return lookup(back, shown, F.when(F.char_length(shown) == 1, F.lower(shown)).otherwise(snake))


def collapsed(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", "")


def fuzzy_key(names: list[Column], keys: list[str]) -> Column:
    """The first key that equals, contains or lies in a name, names in order, separators and case ignored."""
    out = F.lit(None).cast("string")
    for name in reversed(names):
        c = collapsed(name)
        pick = F.lit(None).cast("string")
        for k in reversed(keys):
            plain = "".join(ch for ch in k.lower() if ch.isalnum())
            pick = F.when((c != "") & (c.contains(plain) | F.lit(plain).contains(c)), F.lit(k)).otherwise(pick)
        out = F.coalesce(pick, out)
    return out


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def mail_core(mail: Column) -> Column:
    return F.regexp_replace(F.lower(F.element_at(F.split(mail, "@"), 1)), "[^a-z]", "")


def reason_label(code: Column, daily: bool = False) -> Column:
    return lookup({k: v[daily] for k, v in T.REASON_LABELS.items()}, code, F.replace(F.lower(code), F.lit("_"), F.lit("-")))


def quarantine_id(name: Column, path: Column) -> Column:
    return F.concat(F.left(name, F.lit(40)), F.lit("~"), F.left(F.md5(path), F.lit(8)))


def modifier_side(token: Column) -> Column:
    """l, r or ? of a modifier's kind, null for other keys."""
    return F.when(token.isin("shift_l", "ctrl_l", "alt_l"), "l").when(token.isin("shift_r", "ctrl_r", "alt_r", "alt_gr"), "r").when(token.isin("shift", "ctrl", "alt"), "?")
