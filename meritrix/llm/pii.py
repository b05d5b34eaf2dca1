"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass: at-signs, plus signs,
digits, schemes and cue words. From each anchor a small deterministic parser
walks to the boundaries of an address, number or account and validates it.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.llm.tasks import map_batches, utf8, worker_state

BASE_KINDS = ("email", "ip", "card", "phone")
#: Found besides the base kinds: values behind a cue, URLs with a user part.
CUE_KINDS = ("iban", "secret", "ssn", "url")
KINDS = BASE_KINDS + CUE_KINDS

# Anchors and the characters of each part.
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "access_key")
ACCOUNT_CUES = ("iban", "ssn", "social security")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"[ ().0-9-]*")
_SECRET = re.compile(r"[ \t]{0,4}[=:][ \t]{0,4}[\"']?([A-Za-z0-9_+/=.-]{16,})")
_IBAN = re.compile(r"(?: ?(?:no\.?|number))?[ :]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}){3,8})")
_SSN = re.compile(r"(?: ?(?:no\.?|number))?[ :#]{0,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_USER = re.compile(r"[A-Za-z0-9._~%-]+(?::[^\s/@:]*)?@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s\"'<>]*)?")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """Check digits by remainder 97."""
    plain = text.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


class Finder:
    """Finds spans of all kinds in one text."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for anchor in "@+" + DIGITS:
            self.automaton.add_word(anchor, (anchor, 1))
        for scheme in SCHEMES:
            self.automaton.add_word(scheme, ("scheme", len(scheme)))
        for cue in SECRET_CUES + ACCOUNT_CUES:
            for form in {cue, cue.upper(), cue.capitalize()}:
                self.automaton.add_word(form, ("secret" if cue in SECRET_CUES else cue[:4], len(cue)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """Kind to its (start, end) in code points, in order. Spans of one kind do
        not overlap; those of different kinds may."""
        found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        mail_end = dotted_end = chain_end = 0
        for last, (anchor, length) in self.automaton.iter(text):
            if anchor == "@":
                span = self.email(text, last, mail_end)
                if span:
                    found["email"].append(span)
                    mail_end = span[1]
            elif anchor == "+":
                span = self.phone(text, last)
                if span:
                    found["phone"].append(span)
            elif length == 1:
                if last >= dotted_end:
                    dotted_end = self.addresses(text, last, found["ip"])
                if last >= chain_end:
                    chain_end = self.card(text, last, found["card"])
            else:
                self.behind_cue(text, anchor, last - length + 1, last + 1, found)
        return found

    @staticmethod
    def email(text: str, at: int, floor: int) -> tuple[int, int] | None:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        return (start, domain.end()) if domain else None

    @staticmethod
    def phone(text: str, plus: int) -> tuple[int, int] | None:
        if text[plus + 1:plus + 2] not in DIGITS or plus + 1 == len(text):
            return None
        rest = _PHONE.match(text, plus + 2).group().rstrip(" ().-")
        digits = 1 + len(rest) - sum(map(rest.count, " ().-"))
        return (plus, plus + 2 + len(rest)) if len(rest) >= 2 and 9 <= digits <= 15 else None

    @staticmethod
    def addresses(text: str, start: int, out: list) -> int:
        """All groups of four in a run of dotted numbers; returns the run's end."""
        run = _DOTTED.match(text, start)
        parts, at = run.group().split("."), start
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all((p := part.lstrip("0")) == "" or len(p) <= 3 and int(p) <= 255 for part in four):
                out.append((at, end))
            at = end + 1
        return run.end()

    @staticmethod
    def card(text: str, start: int, out: list) -> int:
        run = _CHAIN.match(text, start)
        digits = run.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(run.span())
        return run.end()

    @staticmethod
    def behind_cue(text: str, cue: str, start: int, end: int, found: dict) -> None:
        if cue == "scheme":
            kind, match, group = "url", _USER.match(text, end), 0
            span = (start, match.end()) if match else None
        else:
            if start and text[start - 1].isalnum():
                return
            kind, pattern = {"secret": ("secret", _SECRET), "iban": ("iban", _IBAN)}.get(cue, ("ssn", _SSN))
            match = pattern.match(text, end)
            span = match.span(1) if match else None
        if not span:
            return
        value = text[slice(*span)]
        if kind == "iban":
            while value and not iban_valid(value):  # what follows the number may look like a part of it
                value = value[:-1].rstrip()
            span = (span[0], span[0] + len(value)) if len(value) >= 15 else None
        elif kind == "secret" and not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)):
            span = None
        if span and (not found[kind] or found[kind][-1][1] <= span[0]):
            found[kind].append(span)


def joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in kinds for s, e in found[kind])


def masked(text: str, found: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span replaced by its kind in angle brackets. Of spans
    that overlap, the one that starts first is shown and the others are joined to it."""
    parts, at = [], 0
    for start, end, kind in sorted((s, -e, k) for k, spans in found.items() for s, e in spans):
        end = -end
        if start >= at:
            parts += (text[at:start], f"<{kind.upper()}>")
        at = max(at, end)
    return "".join((*parts, text[at:]))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
             mask: bool = False) -> DataFrame:
    """(id, kept columns, n_email, n_ip, n_card, n_phone, base_spans, spans) for
    every row, and with ``mask`` also masked_text.

    ``base_spans`` lists the four base kinds as kind:start:end (code points, end
    exclusive), ``spans`` all kinds. A null or empty text has no spans; a null
    text stays null when masked. Repeated rows and null ids stay; columns not
    named in ``keep`` are ignored, whatever their names; an empty table gives no rows. A
    text is held whole in one task, whatever its length; of overlapping spans of one
    kind the leftmost counts.
    """
    narrow = docs.select(id_col, *keep, F.col(text).cast("string").alias("text_to_search"))
    kept = (id_col, *keep)
    kinds = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in kept)
    counts = [f"n_{kind}" for kind in BASE_KINDS]
    schema = f"{kinds}, {', '.join(f'{c} bigint' for c in counts)}, base_spans string, spans string" + (
        ", masked_text string" if mask else "")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        finder = worker_state("pii", Finder)
        found = [finder.spans(raw.decode()) for raw in utf8(batch, "text_to_search")]
        arrays = [*(batch.column(c) for c in kept),
                  *(pa.array([len(f[kind]) for f in found], pa.int64()) for kind in BASE_KINDS),
                  pa.array([joined(f, BASE_KINDS) for f in found], pa.string()),
                  pa.array([joined(f, KINDS) for f in found], pa.string())]
        if mask:
            texts = batch.column("text_to_search").to_pylist()
            arrays.append(pa.array([t if t is None else masked(t, f) for t, f in zip(texts, found)], pa.string()))
        return pa.RecordBatch.from_arrays(arrays, [*kept, *counts, "base_spans", "spans", *["masked_text"] * mask])

    return map_batches(narrow, work, schema)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")
