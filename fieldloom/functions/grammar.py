"""The formula grammar, as fixed patterns.

    formula := part ( '&' part )*
    part    := '[' name ']' | '"' text '"'
    name    := 1+ characters without ']', first and last above U+0020
    text    := 0+ characters without '"'

Two syntaxes read the same text.  ``strict`` follows the grammar, so quotes and
brackets protect an ampersand.  ``lenient`` splits on every ampersand, trims each
piece and takes what is neither bracketed nor quoted as a literal.
"""

# A complete bracketed or quoted part.
TOKEN = r'\[[^\]]*\]|"[^"]*"'
# A bracketed part whose name is neither empty nor padded.
FIELD = r"\A\[[^\]\x00-\x20](?:[^\]]*[^\]\x00-\x20])?\]\z"
# Structural characters: groups 1-7 keep brackets, quotes (closed or not) and
# ampersands; everything between them is dropped by replacing with LEXEMES_KEPT.
LEXEMES = r'(\[)[^\]]*(\])|(")[^"]*(")|(\[)[^\]]*\z|(")[^"]*\z|(&)|[^\["&]+'
LEXEMES_KEPT = "$1$2$3$4$5$6$7"
# Allowed order of structural characters; possessive, so long formulas cannot
# exhaust the regex engine's stack.
LEXEME_ORDER = r'\A(?:(?:\[\]|"")(?:&(?:\[\]|""))*+)?\z'
# The structural characters up to the first that breaks the order, each checked by what follows.
LEXEMES_IN_ORDER = r'\A(?:\[(?=\])|(?!\A)\](?=&|\z)|(?!\A)&(?=["\[])|""(?=&|\z))*+'
# A formula up to the end of its first blank or padded field.
TO_BLANK_FIELD = r'\A(?:[^\["]|"[^"]*"|\[[^\]\x00-\x20](?:[^\]]*[^\]\x00-\x20])?\])*+\[[^\]]*\]'
# Leading and trailing characters up to U+0020.
PADDING = r"\A[\x00-\x20]+|[\x00-\x20]+\z"
PADDING_CHARS = "".join(map(chr, range(0x21)))
# Marks a reference to a pivoted attribute; the column is named without it.
ATTRIBUTE_PREFIX = "a_"

# Error classes, in the order they are tested.
EMPTY = "EMPTY"
ILLEGAL_LEXICON = "ILLEGAL_LEXICON"
BLANK_FIELD = "BLANK_FIELD"
MISMATCH = "MISMATCH"
OK = "OK"

SYNTAXES = ("lenient", "strict")


def check_syntax(syntax: str) -> str:
    if syntax not in SYNTAXES:
        raise ValueError(f"syntax must be one of {SYNTAXES}, not {syntax!r}")
    return syntax
