"""Personal data by anchor expansion: Aho-Corasick finds anchors, local parsers expand each to a whole span."""

from __future__ import annotations

import string
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import free_name

DIGITS = frozenset(string.digits)
ALNUM = frozenset(string.ascii_letters + string.digits)
LOCAL = ALNUM | set("._%+-")
LABEL = ALNUM | {"-"}
PHONE = DIGITS | set(" ().-")
SECRET = ALNUM | set("_-+/=.~")
HOST = LABEL | {"."}
ADDRESS_END = frozenset(" \t\n\r\x0b\x0c<>\"'`|{}\\^")

KINDS = ("email", "ip", "card", "phone", "secret", "account", "address")
SECRET_CUES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api-key", "access_key", "private_key", "auth_key")
ACCOUNT_CUES = ("account", "acct", "konto", "cuenta", "compte", "iban", "ssn")
ACCOUNT_FILL = ("number", "num", "nr", "no", "is", "de", "du")
SPAN = "array<struct<kind:string,start:int,end:int>>"


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for d in string.digits:
        found.add_word(d, ("digit", 1))
    for cue, kind in [("@", "at"), ("+", "plus"), ("://", "scheme"), ("AKIA", "key_id"), ("-----BEGIN ", "block")]:
        found.add_word(cue, (kind, len(cue)))
    for cues, kind in [(SECRET_CUES, "secret"), (ACCOUNT_CUES, "account")]:
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def run_of(t: str, at: int, allowed: frozenset | set) -> int:
    n = len(t)
    while at < n and t[at] in allowed:
        at += 1
    return at


def email_at(t: str, at: int, floor: int) -> tuple[int, int] | None:
    """Local part to the left, not beyond ``floor``; labels to the right, at least two."""
    start = at
    while start > floor and t[start - 1] in LOCAL:
        start -= 1
    end, labels = run_of(t, at + 1, LABEL), 1
    if start == at or end == at + 1:
        return None
    while t[end : end + 1] == "." and t[end + 1 : end + 2] in LABEL:
        end, labels = run_of(t, end + 1, LABEL), labels + 1
    return (start, end) if labels > 1 else None


def ip_at(t: str, at: int) -> tuple[int, list[int]]:
    """End of a chain of up to four numbers with dots between, and the numbers."""
    end = run_of(t, at, DIGITS)
    parts = [t[at:end]]
    while len(parts) < 4 and t[end : end + 1] == "." and t[end + 1 : end + 2] in DIGITS:
        start = end + 1
        end = run_of(t, start, DIGITS)
        parts.append(t[start:end])
    return end, parts


def card_at(t: str, at: int) -> tuple[int, str]:
    """End and digits of a run of digits with at most one space or hyphen between two."""
    end = run_of(t, at, DIGITS)
    digits = [t[at:end]]
    while t[end : end + 1] in (" ", "-") and t[end + 1 : end + 2] in DIGITS:
        start = end + 1
        end = run_of(t, start, DIGITS)
        digits.append(t[start:end])
    return end, "".join(digits)


def phone_at(t: str, at: int) -> int | None:
    """End of a number that begins with the plus at ``at``: its last digit, something between that and the first."""
    if t[at + 1 : at + 2] not in DIGITS:
        return None
    end = run_of(t, at + 2, PHONE)
    while end > at + 3 and t[end - 1] not in DIGITS:
        end -= 1
    return end if end > at + 3 else None


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def secret_after(t: str, end: int, runs: dict | None = None) -> tuple[int, int] | None:
    """A value of at least 8 characters, one a digit, after a cue and ``=`` or ``:``; quotes and spaces may stand between.

    ``runs`` keeps the run that was read last, its end and its last digit: cues that stand in one run don't read it again."""
    at = end
    while t[at : at + 1] in ("'", '"', " ", "\t"):
        at += 1
    if t[at : at + 1] not in ("=", ":"):
        return None
    at += 1
    while t[at : at + 1] in ("=", ">", "'", '"', " ", "\t"):
        at += 1
    runs = {} if runs is None else runs
    if not runs.get("start", 0) <= at < runs.get("end", 0):
        whole = run_of(t, at, SECRET)
        stop, digit = whole, whole - 1
        while stop > at and t[stop - 1] == ".":
            stop -= 1
        while digit >= at and t[digit] not in DIGITS:
            digit -= 1
        runs.update(start=at, end=whole, stop=stop, digit=digit)
    stop = max(at, runs["stop"])
    return (at, stop) if stop - at >= 8 and at <= runs["digit"] else None


def iban_valid(code: str) -> bool:
    return 15 <= len(code) <= 34 and code[:2].isalpha() and code[2:4].isdigit() and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def account_after(t: str, end: int) -> tuple[int, int] | None:
    """An account number after a cue: an IBAN with right check digits, or 6 to 20 digits."""
    at = end
    while True:
        while t[at : at + 1] in (" ", "\t", ":", ".", "#", "="):
            at += 1
        fill = next((w for w in ACCOUNT_FILL if t[at : at + len(w)].lower() == w and t[at + len(w) : at + len(w) + 1] not in ALNUM), None)
        if not fill:
            break
        at += len(fill)
    if at == end or t[at : at + 1] not in ALNUM:
        return None
    if t[at] in DIGITS:
        stop, digits = card_at(t, at)
        return (at, stop) if 6 <= len(digits) <= 20 and t[stop : stop + 1] not in ALNUM else None
    stop, code = at, ""
    while len(code) < 34 and t[stop : stop + 1] and (t[stop] in ALNUM or (t[stop] == " " and t[stop + 1 : stop + 2] in ALNUM)):
        code += t[stop].strip().upper()
        stop += 1
        if t[stop : stop + 1] not in ALNUM and iban_valid(code):
            return at, stop
    return None


def address_at(t: str, at: int, floor: int = 0) -> tuple[int, int] | None:
    """A web address around ``://``: letters to the left, a host with a dot, then everything up to a space or quote. None, before
    anything to the right is read, if it would begin before ``floor``."""
    start = at
    while start > 0 and t[start - 1] in ALNUM:
        start -= 1
    if start < floor:
        return None
    host = at + 3
    end = run_of(t, host, HOST | {"@", ":"})
    name = t[host:end].rpartition("@")[2].partition(":")[0].strip(".")
    if start == at or t[start] in DIGITS or "." not in name:
        return None
    while end < len(t) and t[end] not in ADDRESS_END:
        end += 1
    while end > host and t[end - 1] in ".,;:!?)":
        end -= 1
    return start, end


def spans_of(t: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans, by kind in the order of ``KINDS``, then start; code points, end exclusive.

    Anchors come from left to right. For each kind, ``done`` is where its next match may begin, so the matches of a kind
    don't overlap; a span that fails its check is passed over as a whole. What an anchor would read again is not read: the work
    grows with the text, whatever it repeats.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)
    runs: dict[str, int] = {}
    closing = -1

    def add(kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] >= done[kind]:
            found[kind].append(span)
            done[kind] = span[1]

    for last, (kind, length) in anchors.iter(t):
        at = last - length + 1
        if kind == "digit":
            if at >= done["ip"]:
                end, parts = ip_at(t, at)
                if len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts):
                    found["ip"].append((at, end))
                done["ip"] = end
            if at >= done["card"]:
                end, digits = card_at(t, at)
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append((at, end))
                done["card"] = end
        elif kind == "at":
            add("email", email_at(t, at, done["email"]))
        elif kind == "plus":
            if at >= done["phone"] and (end := phone_at(t, at)):
                if 9 <= sum(c in DIGITS for c in t[at:end]) <= 15:
                    found["phone"].append((at, end))
                done["phone"] = end
        elif kind == "scheme":
            add("address", address_at(t, at, done["address"]))
        elif kind == "key_id":
            if at == 0 or t[at - 1] not in ALNUM:  # else it stands within a run that was read already
                end = run_of(t, last + 1, ALNUM)
                if end - at == 20 and t[at:end].isupper():
                    add("secret", (at, end))
        elif kind == "block":
            if at >= done["secret"]:
                if last > closing:  # the next closing mark, one for all blocks before it
                    closing = t.find("-----END ", last)
                    closing = len(t) if closing < 0 else closing
                end = t.find("-----", closing + 9) + 5 if closing < len(t) else last + 1
                add("secret", (at, max(end, last + 1)))
        elif kind == "secret":
            add("secret", secret_after(t, last + 1, runs))
        elif t[at - 1 : at] not in ALNUM or at == 0:
            add("account", account_after(t, last + 1))
    return [(k, a, b) for k in KINDS for a, b in sorted(found[k])]


def pii_spans(text: str | Column) -> Column:
    """Spans of a text column as ``array<struct<kind, start, end>>``; NULL text counts as empty."""

    @F.arrow_udf(SPAN)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        anchors = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for texts in batches:
            yield pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t.as_py() or "", anchors)] for t in texts], kind)

    return run(text)


def redacted(text: str | Column, spans: str | Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans, one replacement for all."""

    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            out = []
            for t, spans in zip(texts, found):
                t, at, parts = t.as_py(), 0, []
                for s in sorted(spans.as_py() or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [t[at : s["start"]], f"[{s['kind'].upper()}]"]
                    at = max(at, s["end"])
                out.append(None if t is None else "".join(parts) + t[at:])
            yield pa.array(out, pa.string())

    return run(text, spans)


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a column ``pii`` of spans. No row is moved: there is no shuffle."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns], pii_spans(F.col(f"`{text}`")).alias(free_name(df, "pii")))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
