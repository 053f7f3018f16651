"""Patterns in Python's dialect as Java ones.

A pattern is parsed by Python's own parser and written out again sign by sign,
so that it matches the same texts: ``$`` also stands before a last line break
only, ``.`` stops at nothing but a line break, ``\\d``, ``\\w``, ``\\s`` and ``\\b``
know all of Unicode unless the pattern is for ASCII, names of groups become
numbers. What Java cannot express is refused before a job starts.

Ignoring case follows Java's simple case folding for Unicode.
"""

from __future__ import annotations

import re

try:
    from re import _constants as sre
    from re import _parser as sre_parser
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse as sre_parser

# What Python calls digits, parts of words and blanks, inside of brackets.
UNICODE = {
    "digit": r"\p{Nd}",
    "word": r"\p{L}\p{N}_",
    "space": r"\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}",
}
ASCII = {"digit": "0-9", "word": "A-Za-z0-9_", "space": r"\x09-\x0d\x20"}
ANY = r"[\x{0}-\x{10ffff}]"
NO_FORM = {"GROUPREF_EXISTS": "a group that is matched only if another was"}


def _sign(code: int) -> str:
    return chr(code) if chr(code).isascii() and chr(code).isalnum() else f"\\x{{{code:x}}}"


class _Writer:
    def __init__(self, pattern: str, flags: int):
        self.pattern = pattern
        self.classes = ASCII if flags & re.ASCII else UNICODE
        self.flags = flags
        if flags & re.LOCALE:
            self.refuse("the locale flag")

    def refuse(self, what: str) -> None:
        raise ValueError(f"pattern {self.pattern!r} has no Java form: {what}")

    def category(self, category) -> tuple[str, bool]:
        """What a class holds inside of brackets, and whether all but that is meant."""
        name = str(category).removeprefix("CATEGORY_").removeprefix("UNI_").lower()
        return self.classes[name.removeprefix("not_")], name.startswith("not_")

    def word(self, negated: bool) -> str:
        w = f"[{self.classes['word']}]"
        edge = f"(?:(?<={w})(?!{w})|(?<!{w})(?={w}))"
        return f"(?!{edge})" if negated else edge

    def items(self, items) -> str:
        return "".join(self.item(op, argument) for op, argument in items)

    def item(self, op, argument) -> str:
        method = getattr(self, f"on_{op}".lower(), None)
        if method is None:
            self.refuse(NO_FORM.get(str(op), str(op).lower()))
        return method(argument)

    def on_literal(self, code) -> str:
        return _sign(code)

    def on_not_literal(self, code) -> str:
        return f"[^{_sign(code)}]"

    def on_any(self, _) -> str:
        return ANY if self.flags & re.DOTALL else r"[^\n]"

    def on_in(self, parts) -> str:
        negated = parts[0][0] is sre.NEGATE
        inner, others = "", []
        for op, argument in parts[negated:]:
            if op is sre.LITERAL:
                inner += _sign(argument)
            elif op is sre.RANGE:
                inner += f"{_sign(argument[0])}-{_sign(argument[1])}"
            elif op is sre.CATEGORY:
                held, other = self.category(argument)
                if other:
                    others.append(f"[^{held}]")
                else:
                    inner += held
            else:
                self.refuse(str(op).lower())
        if not others:
            return f"[{'^' * negated}{inner}]"
        # Java's brackets in brackets are not to be trusted with a negation.
        either = "|".join([f"[{inner}]"] * bool(inner) + others)
        if negated:
            return f"(?:(?!{either}){ANY})"
        return others[0] if len(others) == 1 and not inner else f"(?:{either})"

    def on_category(self, category) -> str:
        held, other = self.category(category)
        return f"[{'^' * other}{held}]"

    def on_at(self, where) -> str:
        lines = bool(self.flags & re.MULTILINE)
        forms = {
            "AT_BEGINNING": r"(?:\A|(?<=\n))" if lines else r"\A",
            "AT_BEGINNING_LINE": r"(?:\A|(?<=\n))",
            "AT_BEGINNING_STRING": r"\A",
            "AT_END": r"(?:(?=\n)|\z)" if lines else r"(?=\n?\z)",
            "AT_END_LINE": r"(?:(?=\n)|\z)",
            "AT_END_STRING": r"\z",
        }
        name = str(where)
        if name in forms:
            return forms[name]
        if "BOUNDARY" in name:
            return self.word("NON" in name)
        return self.refuse(name.lower())

    def on_branch(self, argument) -> str:
        return "(?:" + "|".join(self.items(branch) for branch in argument[1]) + ")"

    def on_subpattern(self, argument) -> str:
        group, more, less, items = argument
        before = self.flags, self.classes
        self.flags = (self.flags | more) & ~less
        if more & re.ASCII:
            self.classes = ASCII
        if more & re.UNICODE:
            self.classes = UNICODE
        case = "i" if more & re.IGNORECASE else "-i" if less & re.IGNORECASE else ""
        inner = self.items(items)
        self.flags, self.classes = before
        if case:
            inner = f"(?{'iu' if case == 'i' and self.classes is UNICODE else case}:{inner})"
        return f"({inner})" if group is not None else f"(?:{inner})"

    def _repeat(self, argument, sign: str) -> str:
        low, high, items = argument
        most = "" if high is sre.MAXREPEAT else str(int(high))
        inner = self.items(items)
        # A group makes Java recurse, once for each time it matches.
        single = len(items) == 1 and not inner.startswith("(")
        return f"{inner if single else f'(?:{inner})'}{{{int(low)},{most}}}{sign}"

    def on_max_repeat(self, argument) -> str:
        return self._repeat(argument, "")

    def on_min_repeat(self, argument) -> str:
        return self._repeat(argument, "?")

    def on_possessive_repeat(self, argument) -> str:
        return self._repeat(argument, "+")

    def on_atomic_group(self, items) -> str:
        return f"(?>{self.items(items)})"

    def on_groupref(self, group) -> str:
        # A reference to a group that has not matched fails in both dialects.
        return f"(?:\\{group})"

    def on_assert(self, argument) -> str:
        direction, items = argument
        return f"(?{'<' if direction < 0 else ''}={self.items(items)})"

    def on_assert_not(self, argument) -> str:
        direction, items = argument
        return f"(?{'<' if direction < 0 else ''}!{self.items(items)})"

    def on_failure(self, _) -> str:
        return "(?!)"


def java_pattern(pattern: str) -> str:
    """A Java pattern that matches what Python's ``re`` matches by ``pattern``."""
    if not isinstance(pattern, str):
        raise ValueError(f"pattern is no text: {pattern!r}")
    try:
        parsed = sre_parser.parse(pattern)
        re.compile(pattern)
    except (re.error, OverflowError, RecursionError) as error:
        raise ValueError(f"broken pattern {pattern!r}: {error}") from error
    flags = parsed.state.flags
    written = _Writer(pattern, flags).items(parsed)
    if flags & re.IGNORECASE:
        return f"(?{'i' if flags & re.ASCII else 'iu'}){written}"
    return written
