"""Text patterns for personal data.

The word boundary, digit and white-space classes are spelled out because the
contract is Unicode-aware: a letter or digit of any script next to a number
means there is no boundary, and any decimal digit counts as a digit.
"""

from __future__ import annotations

WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
NOT_DIGIT = r"[^\p{Nd}]"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
# A boundary beside a word character needs one look-around only; looking for the
# digit first rejects most positions of a text at once.
OPEN = rf"(?={DIGIT})(?<!{WORD})"
CLOSE = rf"(?!{WORD})"
# General boundary, for matches that may start with punctuation.
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# The formats of the four kinds of personal data.
RUT = rf"{OPEN}{DIGIT}{{1,2}}\.?{DIGIT}{{3}}\.?{DIGIT}{{3}}-[{DIGIT}kK]{CLOSE}"
MOBILE = rf"\+?56{SPACE}?9{SPACE}?{DIGIT}{{4}}{SPACE}?{DIGIT}{{4}}"
EMAIL = rf"{EDGE}[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z|]{{2,}}{EDGE}"
CARD = (
    rf"{OPEN}{DIGIT}{{4}}(?:{SPACE}|-)?{DIGIT}{{4}}(?:{SPACE}|-)?"
    rf"{DIGIT}{{4}}(?:{SPACE}|-)?{DIGIT}{{4}}{CLOSE}"
)
# International number with a plus sign, used only when inspecting.
INTL_PHONE = rf"\+{DIGIT}{{8,15}}{CLOSE}"

# Words that make a national id near them more certain.
RUT_HOTWORDS = r"(?iu)(rut|r\.u\.t|cédula|cedula|identificación|id)"
HOTWORD_WINDOW = 10
