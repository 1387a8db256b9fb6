"""Personal data in texts: anchors found by Aho-Corasick, expanded and checked by small local parsers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans are listed; those of ``BASE`` follow fixed grammars.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account", "ssn", "secret")

DIGIT, AT, PLUS = "digit", "at", "plus"
#: What opens an address, and words that announce an identifier.
SCHEMES = ("http://", "https://", "ftp://", "sftp://")
CUES = {
    "iban": ("iban",),
    "account": ("account", "acct", "a/c", "konto", "kontonummer", "compte", "cuenta"),
    "ssn": ("ssn", "social security number", "social security"),
    "secret": ("token", "secret", "password", "passwd", "api_key", "apikey", "api key", "access_key"),
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
PART = re.compile(r"[0-9]++")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ADDRESS = re.compile(r"[A-Za-z0-9._~%-]++(?::[^\s@/]++@[A-Za-z0-9.-]++)?(?::[0-9]++)?(?:[/?#][^\s\"'<>|\\^`{}]*+)?")
LEAD = re.compile(r"[\x20\t]*+(?:(?:number|no|nr|num|id|code)\b[\x20\t]*+)?[.:#=\x20\t]*+", re.IGNORECASE)
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}+")
ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
SSN = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
SECRET = re.compile(r"[A-Za-z0-9+/_=.-]{8,}+")
SECRET_LEAD = re.compile(r"[\x20\t\"']*+[=:][\x20\t]*+[\"']?+")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, (DIGIT, 1))
    found.add_word("@", (AT, 1))
    found.add_word("+", (PLUS, 1))
    for scheme in SCHEMES:
        found.add_word(scheme, ("url", len(scheme)))
    for kind, cues in CUES.items():
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def valid_iban(code: str) -> bool:
    turned = code[4:] + code[:4]
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


class Scanner:
    """Spans (kind, start, end) of one text after the other, in code points, end exclusive."""

    def __init__(self):
        self._anchors = _automaton()

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        self._text = text
        self._from = dict.fromkeys(KINDS, 0)  # where each kind may begin again
        self._found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
        for last, (kind, size) in self._anchors.iter(lowered):
            if kind == DIGIT:
                if last >= self._from["ip"]:
                    self._ips(last)
                if last >= self._from["card"]:
                    self._card(last)
            elif kind == AT:
                self._email(last)
            elif kind == PLUS:
                self._phone(last)
            elif last - size < 0 or not lowered[last - size].isalnum():
                getattr(self, f"_{kind}")(last - size + 1, last + 1)
        return [(kind, a, b) for kind in KINDS for a, b in self._found[kind]]

    def _keep(self, kind: str, start: int, end: int) -> None:
        if start >= self._from[kind]:
            self._found[kind].append((start, end))
            self._from[kind] = end

    def _email(self, at: int) -> None:
        """The run of local characters before the sign and not in an earlier match, then labels with dots."""
        start, least = at, self._from["email"]
        while start > least and self._text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(self._text, at + 1)
        if start < at and domain:
            self._keep("email", start, domain.end())

    def _ips(self, first: int) -> None:
        """Of a chain of numbers with dots between, each four in turn."""
        end = DOTTED.match(self._text, first).end()
        parts = [m.span() for m in PART.finditer(self._text, first, end)]
        self._from["ip"] = end
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            if all(at_most_255(self._text[a:b]) for a, b in four):
                self._found["ip"].append((four[0][0], four[3][1]))

    def _card(self, first: int) -> None:
        chain = CHAIN.match(self._text, first)
        self._from["card"] = chain.end() if chain else first + 1
        if chain:
            digits = chain[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                self._found["card"].append(chain.span())

    def _phone(self, plus: int) -> None:
        number = PHONE.match(self._text, plus)
        if number and 8 <= sum("0" <= c <= "9" for c in number[0]) <= 15:
            self._found["phone"].append(number.span())

    def _url(self, start: int, behind: int) -> None:
        rest = ADDRESS.match(self._text, behind) if start >= self._from["url"] else None
        if rest:
            end = behind + len(rest[0].rstrip(".,;:!?)]"))
            if end > behind:
                self._keep("url", start, end)

    def _iban(self, start: int, behind: int) -> None:
        found = IBAN.match(self._text, LEAD.match(self._text, behind).end())
        if found:
            # Words may follow behind a space: the longest code of whole groups that is valid.
            groups, end = found[0].split(" "), found.end()
            for n in range(len(groups), 0, -1):
                if not self._text[end:end + 1].isalnum() and valid_iban("".join(groups[:n]).upper()):
                    self._keep("iban", found.start(), end)
                    return
                end -= len(groups[n - 1]) + 1

    def _account(self, start: int, behind: int) -> None:
        found = ACCOUNT.match(self._text, LEAD.match(self._text, behind).end())
        if found and 6 <= sum(c not in " -" for c in found[0]) <= 17:
            self._keep("account", *found.span())

    def _ssn(self, start: int, behind: int) -> None:
        found = SSN.match(self._text, LEAD.match(self._text, behind).end())
        if found and found[1] not in ("000", "666") and found[1][0] != "9" and found[2] != "00" and found[3] != "0000":
            self._keep("ssn", *found.span())

    def _secret(self, start: int, behind: int) -> None:
        lead = SECRET_LEAD.match(self._text, behind)
        if lead and lead.end() >= self._from["secret"] and (found := SECRET.match(self._text, lead.end())):
            self._keep("secret", *found.span())


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, spans (kind, start, end), by kind as in ``KINDS``, then start.

    One Aho-Corasick pass finds digits, plus and at-signs, schemes of addresses and words that announce
    an identifier; from each anchor a parser of that kind expands to the span and checks it. The
    base kinds are what these patterns match, leftmost and without overlap inside a kind: email
    ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip ``[0-9]+(\\.[0-9]+){3}`` with parts up to
    255; card ``[0-9]([ -]?[0-9])+`` of 16 to 19 digits that pass Luhn; phone
    ``\\+[0-9][ ().0-9-]+[0-9]`` of 8 to 15 digits; failing matches are dropped, not retried. Added:
    web addresses behind a scheme, IBANs that pass their check sum, account numbers of 6 to 17
    digits, social security numbers and secrets behind their words. Spans of different kinds may
    overlap. Places count code points, ends are exclusive; whole texts are scanned, in time that
    grows with the text and its anchors. Null text counts as empty and has no spans. Other columns are not
    read; repeated rows are scanned each for itself; an empty table gives no rows.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            flat, ends = [], [0]
            for text in batch.column(1):
                flat += scanner.scan(text.as_py())
                ends.append(len(flat))
            kinds, starts, stops = (list(x) for x in zip(*flat)) if flat else ([], [], [])
            spans = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())],
                ["kind", "start", "end"],
            )
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "spans"])

    return rows.mapInArrow(scanned, f"doc_id long, spans {SPANS}")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first and longest names all."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def without_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text with all spans of ``find`` replaced by their kinds; null text stays null."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            texts = [None if t is None else redact(t, scanner.scan(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(cleaned, "doc_id long, text string")
