"""Column expressions that read C source text.

Everything here is a projection: built-in regular expressions cut a file into a
short array of chunks, one fold over that array finds the function definitions,
and the structural counts come from the text of each function. No step needs a
shuffle, a window or a Python worker, so a scan of any size stays one stage.

Quantifiers are possessive throughout: the matcher then loops instead of
recursing and cannot overflow its stack on long literals or comments. Only a run
of one class is greedy where nothing behind it could match inside the run: it
takes the same text, by the matcher's fastest loop.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- lexical pieces ---------------------------------------------------------------

_ESCAPE = r"\\(?:\r\n|[\s\S])"
LINE_COMMENT = rf"//[^\n\\]*+(?:{_ESCAPE}[^\n\\]*+)*+"
BLOCK_COMMENT = r"/\*[^*]*+\*++(?:[^/*][^*]*+\*++)*+/"
STRING = rf'"[^"\\\n]*+(?:{_ESCAPE}[^"\\\n]*+)*+"'
CHAR = rf"'[^'\\\n]*+(?:{_ESCAPE}[^'\\\n]*+)*+'"
# In C a '#' outside literals and comments always opens a directive.
DIRECTIVE = (
    rf'#(?:[^\n\\/"]+|{_ESCAPE}|{BLOCK_COMMENT}|{LINE_COMMENT}|{STRING}|[/"])*+'
)
IDENT = r"[A-Za-z_]\w*+"
NUMBER = r"\.?[0-9](?:[eEpP][+\-]|[\w.])*+"

# One token per match; the last alternative makes the tokens tile the text.
TOKEN = "|".join(
    [
        LINE_COMMENT,
        BLOCK_COMMENT,
        DIRECTIVE,
        STRING,
        CHAR,
        IDENT,
        NUMBER,
        "->",
        r"\s++",
        r"[\s\S]",
    ]
)

_FILL = rf"[^{{}}\"'/#]++|{STRING}|{CHAR}|{BLOCK_COMMENT}|{LINE_COMMENT}|[\"'/]"
_BLANKS = rf"(?:\s++|{BLOCK_COMMENT}|{LINE_COMMENT})*+"
# Directives that move neither conditions nor braces, with the blanks behind them.
_PLAIN_DIRECTIVES = rf"(?:(?!#[ \t]*+(?:if|el|endif)){DIRECTIVE}\s*+)++"
# Fill without stray quotes; no literal right before a brace, which may open a linkage block.
_CLOSED_FILL = rf"[^{{}}\"'/#]++|{STRING}(?!{_BLANKS}\{{)|{CHAR}|{BLOCK_COMMENT}|{LINE_COMMENT}|/"


def _closed_block(depth: int = 8) -> str:
    """Pattern of a block without directives whose braces close, at most ``depth`` levels deep."""
    pattern = rf"\{{(?:{_CLOSED_FILL})*+\}}"
    for _ in range(depth - 1):
        pattern = rf"\{{(?:{_CLOSED_FILL}|{pattern})*+\}}"
    return pattern


# A chunk is a run of plain directives, a conditional, everything up to and including a block that closes, or up to the next brace.
CHUNK = rf"{_PLAIN_DIRECTIVES}|{DIRECTIVE}|(?:{_CLOSED_FILL})*+{_closed_block()}|(?:{_FILL})++[{{}}]?+|[{{}}]"
# The part of a chunk up to its first brace, if that opens a block.
_OPENING = rf"\A(?:{_FILL})*+\{{"

_STATEMENT_FILL = (
    rf"[^;{{}}\"'/#]++|{STRING}|{CHAR}|{BLOCK_COMMENT}|{LINE_COMMENT}|{DIRECTIVE}|[\"'/]"
)
# Finished declarations and leading trivia before a definition, then the definition.
_DEFINITION = (
    rf"\A(?:(?:{_STATEMENT_FILL})*+;)*+"
    rf"(?:\s++|{BLOCK_COMMENT}|{LINE_COMMENT}|{DIRECTIVE})*+((?s:.*+))"
)

# The leading look-ahead rejects most positions with one test.
_LITERAL_OR_TRIVIA = (
    r"(?=[\"'/#])(?:"
    rf'(")[^"\\\n]*+(?:{_ESCAPE}[^"\\\n]*+)*+"'
    rf"|(')[^'\\\n]*+(?:{_ESCAPE}[^'\\\n]*+)*+'"
    rf"|{BLOCK_COMMENT}|{LINE_COMMENT}|{DIRECTIVE})"
)


# Twice the nesting that the C standard asks a compiler for in expressions and declarators.
NESTING = 127


def _balanced(opening: str, closing: str, depth: int = NESTING) -> str:
    """Pattern of a bracketed group nested at most ``depth`` levels."""
    inner = rf"[^{opening}{closing}]"
    pattern = rf"{opening}{inner}*+{closing}"
    for _ in range(depth):
        pattern = rf"{opening}(?:{inner}+|{pattern})*+{closing}"
    return pattern


_GROUP = _balanced(r"\(", r"\)")
_INDEX = _balanced(r"\[", r"\]")
_ATTRIBUTE = rf"__(?:attribute|declspec|asm)\w*+\s*+{_GROUP}"
# What may stand between the parameters and the body: macro words, and old-style declarations.
_TRAILING = rf"(?:(?!(?:struct|union|enum)\b)(?:[A-Z_][A-Z0-9_]*+\b\s*+{_GROUP}|{IDENT})\s*+)*+"
_OLD_STYLE = rf"(?:{IDENT}[^;{{}}()=]*+(?:{_GROUP}[^;{{}}()=]*+)*+;\s*+)++"
_SIGNATURE = rf"({IDENT}|{_GROUP})\s*+({_GROUP})\s*+(?:{_OLD_STYLE}|{_TRAILING})\z"

# Words of the C grammar that look like a callee but are none.
NON_CALL_WORDS = [
    "if", "for", "while", "switch", "return", "do", "else", "case", "goto",
    "sizeof", "_Alignof", "alignof", "__alignof__", "offsetof", "_Generic",
    "typeof", "__typeof__", "_Static_assert", "static_assert",
    "asm", "__asm__", "__asm", "__attribute__", "__attribute", "__declspec",
    "void", "char", "short", "int", "long", "float", "double",
    "signed", "unsigned", "bool", "_Bool", "struct", "union", "enum",
    "const", "volatile", "static", "extern", "register", "inline", "typedef",
]


def _any_of(words: list[str]) -> str:
    """Pattern of any of ``words``, told apart by their first letters."""
    rest = {word[0]: [w[1:] for w in words if w[0] == word[0]] for word in words}
    return "|".join(f"{first}(?:{'|'.join(ends)})" for first, ends in rest.items())


_NO_CALL = rf"(?:{_any_of(NON_CALL_WORDS)})\b"
# Labels of the control-flow list, in output (sorted) order.
CONTROL_FLOW_LABELS = [
    "break", "continue", "do_while", "for", "goto", "if", "return", "switch", "while",
]

_SUFFIX = rf"\s*+(?:(?:->|\.)\s*+{IDENT}|{_INDEX})"
# Members, indexes, and calls whose result is used further.
_CHAIN = rf"(?:{_SUFFIX}|\s*+{_GROUP}(?=\s*+(?:->|[.\[(])))*+"
_FN_POINTER = r"\s*+\(\s*+\*[\s*]*+\w++\s*+\)\s*+\("
_CONDITION = rf"(?=[fisw])\b(?:if|while|for|switch)\s*+({_GROUP})"
_CALL = (
    # only a bracket, or a word before a bracket or a member, is looked at closely
    r"(?=[A-Za-z_(])(?:(?=\()|(?<!\w)(?=\w++\s*+[(\[.\-]))(?=("
    # name, receiver chain or indexed name; not the declarator  type (*name)(
    rf"(?<![\w.])(?<![.>]\s)(?<!->)(?!{_NO_CALL}){IDENT}"
    rf"(?!{_FN_POINTER}){_CHAIN}(?=\s*+\()(?!{_FN_POINTER})"
    # (*fn)(..)  and  (*ops)->fn(..), unless it declares a function pointer
    rf"|\(\s*+\*(?<=(?:\breturn|\belse|[^\w\s*)\]])\s?\(\s?\*)(?:[^()]++|{_GROUP})*+\){_CHAIN}(?=\s*+\()"
    # (expression)->fn(..)
    rf"|(?<![\w)\]])(?:(?<![\w)\]]\s)|(?<=\breturn\s)|(?<=\belse\s)){_GROUP}(?=\s*+(?:->|[.\[])){_CHAIN}(?=\s*+\()))"
)
# What makes a callee more than a word and its members: a bracket that closes before a call, a member or an index.
_AFTER_BRACKET = r"[)\]]\s*+[(\[.\-]"
_PLAIN_CALLEE = (
    rf"(?<!\.)(?<![.>]\s)(?<!->)(?!{_NO_CALL}){IDENT}(?:\s*+(?:->|\.)\s*+{IDENT})*+(?=\s*+\()"
)
# The same callees as _CALL where no bracket closes like this; words are passed over as a whole.
_PLAIN_CALL = rf"\G(?:\W+|\w++(?!\s*+(?:[(.]|->))|(?!{_PLAIN_CALLEE})\w+)*+({_PLAIN_CALLEE})"
# Blanks within a callee, or more of them before a word than its look-behinds reach over.
_MEMBER_BLANKS = r"\s(?:->|\.)|(?:->|\.)\s|>\s\s"
# A callee up to and including each call within it.
_INNER_CALL = rf"\A(?:{IDENT}|{_GROUP})(?:{_SUFFIX})*+|\s*+{_GROUP}(?:{_SUFFIX})*+"

_KEYWORD = r"(?=[bcdfgirsw])\b(?:if|for|while|do|switch|return|break|continue|goto)\b"

# A '*' that belongs to a named declarator of the header.
_HEADER_STAR = r"\*(?=[\s*]*+[A-Za-z_(])"
_INITIALISER = rf"=(?:[^,;(){{}}]++|{_GROUP})*+"
_DECLARATOR = rf"{IDENT}(?:\s*+\[[^\[\]]*+\])*+(?:\s*+{_INITIALISER})?+"
# Declarator list  type *a, **b = x  at the start of a statement.
_LOCAL_POINTERS = (
    r"(?=[{};f])(?:[{};]|\bfor\s*+\()\s*+(?!(?:return|goto|else|case|sizeof)\b)"
    rf"(?:{IDENT}\s*+)++(\*[\s*]*+{_DECLARATOR}"
    rf"(?:\s*+,[\s*]*+{_DECLARATOR})*+)(?=\s*+[=;,\[){{])"
)
# Stars of a local function pointer  type (*name)(
_LOCAL_FN_POINTER = (
    r"[{};]\s*+(?!(?:return|goto|else|case|sizeof)\b)"
    rf"(?:{IDENT}\s*+)++\(\s*+(\*[\s*]*+){IDENT}\s*+\)\s*+\("
)
# A statement  name * other;  multiplies two variables, or declares a pointer if the name is a type.
_EITHER = (
    rf"(?=[{{}};f])(?:[{{}};]|\bfor\s*+\()\s*+(?!(?:{'|'.join(NON_CALL_WORDS)})\b)"
    rf"({IDENT}\s*+\*[\s*]*+{IDENT}(?:\s*+\[[^\[\]]*+\])*+(?:\s*+,[\s*]*+{_DECLARATOR})*+)(?=\s*+;)"
)
_BRACES = _balanced(r"\{", r"\}", 20)
_TYPEDEF = rf"\btypedef\b((?:[^;{{}}]++|{_BRACES})*+);"
# What names a type without doubt: a cast to a pointer, a declaration of two names, a pointer parameter.
_POINTER_CAST = rf"\(\s*+(?:const\s++)?+({IDENT})\s*+\*[\s*]*+\)"
_PLAIN_DECLARATION = rf"[{{}};]\s*+(?!(?:{'|'.join(NON_CALL_WORDS)})\b)({IDENT})\s++{IDENT}\s*+(?=[;=,\[])"
_POINTER_PARAMETER = rf"[(,]\s*+(?:const\s++)?+({IDENT})\s*+\*[\s*]*+(?:const\s++)?+{IDENT}\s*+(?=[,)\[])"
# Type names of the standard headers.
STANDARD_TYPES = [
    "FILE", "bool", "char16_t", "char32_t", "clock_t", "div_t", "errno_t", "fpos_t", "int16_t", "int32_t", "int64_t",
    "int8_t", "intmax_t", "intptr_t", "jmp_buf", "off_t", "ptrdiff_t", "sig_atomic_t", "size_t", "ssize_t", "time_t",
    "uint16_t", "uint32_t", "uint64_t", "uint8_t", "uintmax_t", "uintptr_t", "va_list", "wchar_t", "wint_t",
]


def chunks(text: Column) -> Column:
    """Array of chunks that tile ``text``; braces in literals never end a chunk."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def tokens(text: Column) -> Column:
    """Array of C tokens, trivia included, that tile ``text``."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def without_trivia(code: Column) -> Column:
    """``code`` with comments and directives blanked and literals emptied."""
    return F.regexp_replace(code, _LITERAL_OR_TRIVIA, "$1$1$2$2 ")


def squeezed(clean: Column) -> Column:
    """Every run of blanks as one space, so that look-behinds stay short."""
    return F.regexp_replace(clean, r"\G((?:\S+| (?!\s))*+)\s+", "$1 ")


# --- function definitions ---------------------------------------------------------

_SCAN_FIELDS = ["depth", "cond", "skip", "at", "first", "is_fn", "odd", "spans"]
_SCAN_STATE = (
    "struct<depth:int,cond:int,skip:int,at:int,first:int,is_fn:boolean,odd:int,"
    "spans:array<struct<first:int,last:int>>>"
)


# An old-style definition with leading declarations: it starts where its header does.
_BETWEEN = rf"(?:\s|{BLOCK_COMMENT}|{LINE_COMMENT}|{DIRECTIVE})"
_OLD_HEAD = rf"(?:{IDENT}[\s*]*+)++{_GROUP}{_BETWEEN}*+"
_OLD_PARAMETER = rf"(?:{IDENT}[^;{{}}()=/#]*+(?:{_GROUP}[^;{{}}()=/#]*+)*+;{_BETWEEN}*+)"
_OLD_START = rf"{_OLD_HEAD}{_OLD_PARAMETER}++\{{"
_OLD_DEFINITION = rf"\A(?:(?:{_STATEMENT_FILL})*+;)*?{_BETWEEN}*+({_OLD_START}(?s:.*+))"
# The header of a definition with old-style parameter declarations, up to its brace.
_OLD_HEADER = rf"(?:\A|[;}}])(?:[^;=(){{}}]*[^\w;=(){{}}])?{IDENT}\s*+{_GROUP}\s*+{_OLD_STYLE}\{{\z"
_HEADER = rf"(?:{IDENT}|\))\s*+{_GROUP}\s*+{_TRAILING}\{{\z"


def _without_attributes(clean: Column) -> Column:
    return F.when(clean.contains("__"), F.regexp_replace(clean, _ATTRIBUTE, " ")).otherwise(clean)


def _head(chunk_array: Column, first: Column, at: Column, opening: Column) -> Column:
    """Cleaned text from the end of the last top-level block to ``opening``, the part of chunk ``at`` up to its first brace,
    directives left out."""
    before = F.filter(F.slice(chunk_array, first + 1, at - first), lambda c: ~c.startswith("#"))
    parts = F.when(at == first, opening).otherwise(F.array_join(F.concat(before, F.array(opening)), " "))
    return _once(without_trivia(parts), _without_attributes)


_FUNCTION, _KNOWN, _ODD = 0, 1, 2


def _block_kind(head: Column) -> Column:
    """What the brace that ends ``head`` opens: a function, which it does after a parameter list and what may
    follow it; a type or an initialiser; or something else."""
    last = F.substring_index(head, ";", -1)
    return (
        F.when(last.contains("=") | ~head.contains("("), F.when(last.rlike(r"=|\b(?:struct|union|enum)\b"), _KNOWN).otherwise(_ODD))
        .when(last.rlike(_HEADER) | (head.contains(";") & head.rlike(_OLD_HEADER)), _FUNCTION)
        .when(last.rlike(r"\b(?:struct|union|enum)\b"), _KNOWN)
        .otherwise(_ODD)
    )


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _opens_linkage_block(chunk: Column) -> Column:
    return chunk.contains("extern") & without_trivia(chunk).rlike(r'\bextern\s*""\s*\{\z')


def scan_chunks(chunk_array: Column) -> Column:
    """Fold over the chunks of one file: brace depth and spans of definitions.

    Inside a function only the first branch of a preprocessor conditional moves
    the brace depth, so ``#if`` / ``#else`` pairs that both open a block stay
    balanced. The brace of a linkage block is transparent. ``odd`` counts the top-level
    blocks that are neither function, type, initialiser nor linkage block. A block that closes within its chunk
    moves nothing unless it stands at the top level.
    """
    zero = F.expr(
        "named_struct('depth',0,'cond',0,'skip',0,'at',0,'first',0,'is_fn',false,'odd',0,"
        "'spans',cast(array() as array<struct<first:int,last:int>>))"
    ).cast(_SCAN_STATE)

    def step(state: Column, chunk: Column) -> Column:
        depth, cond, skip = state["depth"], state["cond"], state["skip"]
        at, first, none = state["at"], state["first"], F.lit(0)

        def moved(**changed: Column) -> Column:
            fields = {name: state[name] for name in _SCAN_FIELDS} | changed
            fields["at"] = at + 1
            return F.struct(*[fields[name].alias(name) for name in _SCAN_FIELDS])

        def kind_of(opening: Column) -> Column:
            return _once(_head(chunk_array, first, at, opening), _block_kind)

        opened = _once(
            kind_of(chunk),
            lambda kind: moved(
                depth=F.lit(1), is_fn=kind == _FUNCTION, odd=state["odd"] + (kind == _ODD).cast("int")
            ),
        )
        span = F.array(F.struct(first.alias("first"), at.alias("last")))

        def at_top(opening: Column) -> Column:
            closed = _once(
                kind_of(opening),
                lambda kind: moved(
                    first=at + 1, odd=state["odd"] + (kind == _ODD).cast("int"),
                    spans=F.when(kind == _FUNCTION, F.concat(state["spans"], span)).otherwise(state["spans"]),
                ),
            )
            return F.when(opening == "", moved(first=at + 1)).otherwise(closed)

        return (
            F.when(
                chunk.startswith("#"),
                F.when(chunk.rlike(r"\A#[ \t]*+if"), moved(cond=cond + 1))
                .when(
                    chunk.rlike(r"\A#[ \t]*+el") & (skip == 0) & (depth > 0), moved(skip=cond)
                )
                .when(
                    chunk.rlike(r"\A#[ \t]*+endif"),
                    moved(
                        cond=F.greatest(cond - 1, none),
                        skip=F.when(skip == cond, none).otherwise(skip),
                    ),
                )
                .otherwise(moved()),
            )
            .when(skip > 0, moved())
            .when(
                chunk.endswith("{"),
                F.when(depth > 0, moved(depth=depth + 1))
                .when(_opens_linkage_block(chunk), moved(first=at + 1))
                .otherwise(opened),
            )
            .when(
                chunk.endswith("}"),
                F.when(depth == 0, _once(F.regexp_extract(chunk, _OPENING, 0), at_top))
                .when(chunk.contains("{") & chunk.rlike(_OPENING), moved())
                .when(depth > 1, moved(depth=depth - 1))
                .when(
                    state["is_fn"], moved(depth=none, first=at + 1, spans=F.concat(state["spans"], span))
                )
                .otherwise(moved(depth=none, first=at + 1)),
            )
            .otherwise(moved())
            .cast(_SCAN_STATE)
        )

    return F.aggregate(chunk_array, zero, step)


def definition_texts(chunk_array: Column, scan: Column) -> Column:
    """Exact source slice of every definition of a file, in file order."""

    def cut(span: Column) -> Column:
        length = span["last"] - span["first"] + 1
        text = F.array_join(F.slice(chunk_array, span["first"] + 1, length), "")
        # Old-style declarations end in ';' like those that stand before a definition.
        return _once(text, lambda t: _once(
            F.regexp_extract(t, _DEFINITION, 1),
            lambda plain: F.when(plain.startswith("{"), F.regexp_extract(t, _OLD_DEFINITION, 1)).otherwise(plain),
        ))

    return F.transform(scan["spans"], cut)


# --- files of plain shape ---------------------------------------------------------

_LEXED = rf"{STRING}|{CHAR}|{BLOCK_COMMENT}|{LINE_COMMENT}|/"
_OF_IF, _OF_ELSE, _OF_ENDIF = (rf"(?=#[ \t]*+{word}){DIRECTIVE}" for word in ("if", "el", "endif"))
_NO_ELSE = rf"(?!#[ \t]*+el){DIRECTIVE}"


def _conditionals(depth: int) -> str:
    """Pattern of text, braces included, whose conditionals close, nested at most ``depth`` levels."""
    pattern = rf"[^\"'/#]+|{_LEXED}|(?!#[ \t]*+(?:if|endif)){DIRECTIVE}"
    inner = pattern
    for _ in range(depth):
        inner = rf"{pattern}|{_OF_IF}(?:{inner})*+{_OF_ENDIF}"
    return inner


def _plain_block(depth: int = 6) -> str:
    """Pattern of a block whose braces close if of each conditional the first branch is taken, at most ``depth`` levels deep."""
    text, rest = r"[^{}\"'/#]+", rf"{_LEXED}|{_NO_ELSE}|{_OF_ELSE}(?:{_conditionals(1)})*+{_OF_ENDIF}"
    pattern = rf"\{{(?:{text}|{rest})*+\}}"
    for _ in range(depth - 1):
        pattern = rf"\{{(?:{text}|{pattern}|{rest})*+\}}"
    return pattern


_GAP = rf"(?:\s++|{BLOCK_COMMENT}|{LINE_COMMENT}|{DIRECTIVE})"
_CLOSED_CONDITIONALS = rf"\A(?:{_conditionals(4)})*+\z"
_PLAIN_GROUP = _balanced(r"\(", r"\)", 4).replace("[^", "[^;{}=\"'/#")
_PLAIN_PARAMETER = rf"{IDENT}[^;{{}}()=/#\"']*+(?:{_PLAIN_GROUP}[^;{{}}()=/#\"']*+)*+;{_GAP}*+"
# A word that no bracket follows, and what may stand between the parameters and the body.
_PLAIN_WORD = rf"{IDENT}(?!\s*+\()"
_PLAIN_TRAILING = (
    rf"{_GAP}*+(?:(?!(?:struct|union|enum)\b)(?:[A-Z_][A-Z0-9_]*+\b\s*+{_PLAIN_GROUP}|{IDENT}){_GAP}*+)*+(?=\{{)"
)
# Declarations may stand before the next brace: it is not reached in text without quotes, comments and directives.
_MAYBE_DECLARED = r"(?![^;{}\"'/#]*\{)"
_PLAIN_HEADER = (
    rf"{_MAYBE_DECLARED}(?:{_PLAIN_WORD}[\s*]*+)*+{IDENT}\s*+{_PLAIN_GROUP}{_GAP}*+(?:{_PLAIN_PARAMETER})++(?=\{{)"
    rf"|(?:(?:{_PLAIN_WORD}|\*)\s*+)*+(?:{IDENT}\s*+{_PLAIN_GROUP}{_PLAIN_TRAILING}"
    rf"|(?:{IDENT}\s*+)?+{_PLAIN_GROUP}\s*+{_PLAIN_GROUP}{_PLAIN_TRAILING})"
)
# Where an old-style definition starts, or a run of declarations too long to be told from one at every step.
_MAYBE_OLD = rf"{_OLD_HEAD}{_OLD_PARAMETER}{{1,64}}+(?:\{{|{_OLD_PARAMETER})"
# Head of a block that is no function: without a parameter list, or an initialiser.
_PLAIN_DATA = (
    rf"{IDENT}(?:[^;{{}}()\"'/#]+|{BLOCK_COMMENT}|{LINE_COMMENT}|{DIRECTIVE})*+(?=\{{)"
    rf"|[^;{{}}=\"'/#]+=(?:[^;{{}}\"'/#]+|{BLOCK_COMMENT}|{LINE_COMMENT})*+(?=\{{)"
)
# Trivia, declarations and data, then a definition, the end, or a single character where the shape is not plain; behind it,
# unless it is a brace, the rest of the file is passed over.
_PLAIN_DEFINITION = (
    rf"(?:{_GAP}++|[^;{{}}()\"'/#]*;|{_MAYBE_DECLARED}(?!{_MAYBE_OLD})(?:[^;{{}}\"'/#]+|{_LEXED}|{DIRECTIVE})*+;"
    rf"|(?:{_PLAIN_DATA}){_plain_block()})*+"
    rf"((?:{_PLAIN_HEADER}){_plain_block()}|\z|[\s\S])(?:(?<!\}})[\s\S]*+)?+"
)


def plain_parts(text: Column) -> Column:
    """Definitions of a file of plain shape, found by one pattern without a fold, and an empty part where it ends.

    Where the shape is not plain a part is a single character, which no definition is; null for files whose conditionals
    do not close or that name attributes. The pattern accepts only heads of which ``scan_chunks`` finds the same.
    """
    conditional = text.contains("#") & text.rlike(r"#[ \t]*+(?:if|el|endif)")
    closed = ~conditional | text.rlike(_CLOSED_CONDITIONALS)
    attributes = text.contains("__") & text.rlike("__(?:attribute|declspec|asm)")
    return F.when(closed & ~attributes, F.regexp_extract_all(text, F.lit(_PLAIN_DEFINITION), F.lit(1)))


def plain_definitions(parts: Column) -> Column:
    """Exact source slices of ``plain_parts``; null if a part of the file is not of plain shape."""
    return F.when(~F.exists(parts, lambda part: F.length(part) == 1), F.array_remove(parts, ""))


# --- header -----------------------------------------------------------------------


def header_of(clean: Column) -> Column:
    """Part of a cleaned definition before the body, blanks squeezed and attributes removed."""
    return _without_attributes(squeezed(F.substring_index(clean, "{", 1)))


def body_of(clean: Column) -> Column:
    length = F.octet_length(F.substring_index(clean, "{", 1))
    return F.substr(clean.cast("binary"), length + 1).cast("string")


def signature(header: Column) -> Column:
    """The name and the parameters of a header with what follows them, empty if it has none."""
    return F.regexp_extract(header, _SIGNATURE, 0)


def function_name(signature: Column) -> Column:
    name = F.regexp_extract(signature, rf"\A(?:{IDENT}|{_GROUP})", 0)
    return F.when((name == "") | name.isin(NON_CALL_WORDS), F.lit("<unknown>")).otherwise(name)


def param_count(signature: Column) -> Column:
    """Parameter declarations: ``()`` is 0, ``(void)`` is 1, ``...`` is none."""
    group = F.regexp_extract(signature, rf"\A(?:{IDENT}|{_GROUP})\s*+({_GROUP})", 1)
    inner = F.regexp_replace(
        F.substr(group, F.lit(2), F.length(group) - 2), rf"{_GROUP}|\s++", ""
    )
    return F.size(F.array_remove(F.array_remove(F.split(inner, ","), ""), "..."))


# --- body counts ------------------------------------------------------------------


def keywords(clean: Column) -> Column:
    """Control-flow keywords of a cleaned definition in source order, each between two blanks of its own."""
    words = F.regexp_extract_all(clean, F.lit(_KEYWORD), F.lit(0))
    return F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))


def keyword_counts(words: Column) -> Column:
    """Struct with the number of each control-flow keyword."""
    names = ["if", "for", "while", "do", "switch", "return", "break", "continue", "goto"]

    def count(name: str) -> Column:
        rest = F.replace(words, F.lit(f" {name} "), F.lit(""))
        return ((F.octet_length(words) - F.octet_length(rest)) / (len(name) + 2)).cast("int").alias(name)

    return F.struct(*[count(name) for name in names])


def control_flow_elements(counts: Column) -> Column:
    """Sorted distinct control-flow labels; every ``do`` consumes one ``while``."""
    present = {
        "break": counts["break"] > 0,
        "continue": counts["continue"] > 0,
        "do_while": counts["do"] > 0,
        "for": counts["for"] > 0,
        "goto": counts["goto"] > 0,
        "if": counts["if"] > 0,
        "return": counts["return"] > 0,
        "switch": counts["switch"] > 0,
        "while": counts["while"] > counts["do"],
    }
    return F.array_compact(
        F.array(*[F.when(present[label], F.lit(label)) for label in CONTROL_FLOW_LABELS])
    )


def call_names(body: Column) -> Column:
    """Callee texts of a cleaned body, in source order, duplicates kept.

    A callee that contains calls is followed by the callees of these: of ``f(1)->g(2)`` they are
    ``f(1)->g`` and ``f``.
    """

    def every(text: Column, pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))

    def found(text: Column) -> Column:
        return (
            F.when(text.rlike(_AFTER_BRACKET), every(squeezed(text), _CALL))
            .when(text.rlike(_MEMBER_BLANKS), every(squeezed(text), _PLAIN_CALL))
            .otherwise(every(text, _PLAIN_CALL))
        )

    return _once(_once(F.regexp_replace(body, _CONDITION, "$1;"), found), _with_inner_calls)


def _with_inner_calls(found: Column) -> Column:
    """Callee texts without blanks, each followed by the callees of the calls that it contains."""
    names = F.transform(found, lambda name: F.regexp_replace(name, r"\s+", ""))

    def prefixes(name: Column, parts: Column) -> Column:
        sizes = F.sequence(F.size(parts), F.lit(1), F.lit(-1))
        several = F.transform(sizes, lambda n: F.array_join(F.slice(parts, F.lit(1), n), ""))
        return F.when(F.size(parts) > 1, several).otherwise(F.array(name))

    def with_inner(name: Column) -> Column:
        parts = F.regexp_extract_all(name, F.lit(_INNER_CALL), F.lit(0))
        return F.when(name.contains("("), _once(parts, lambda p: prefixes(name, p))).otherwise(F.array(name))

    every = F.filter(F.flatten(F.transform(names, with_inner)), lambda name: (name != "") & ~name.isin(NON_CALL_WORDS))
    # Without a bracket no callee contains another, and the pattern has left out the words that call nothing.
    text = F.array_join(found, "\n")
    plain = F.split(F.replace(text, F.lit(" "), F.lit("")), "\n")
    return F.when(F.size(found) == 0, found).when(text.contains("("), every).otherwise(plain)


def pointer_count(header: Column, body: Column) -> Column:
    """Named pointer declarators of return type, parameters and locals."""
    in_header = F.when(header.contains("*"), F.regexp_count(header, F.lit(_HEADER_STAR))).otherwise(0)
    return in_header + F.when(body.contains("*"), _local_pointers(body)).otherwise(0)


def _local_pointers(body: Column) -> Column:
    lists = F.array_join(F.regexp_extract_all(body, F.lit(_LOCAL_POINTERS), F.lit(1)), ",")
    pointers = F.concat(
        F.regexp_replace(lists, _INITIALISER, ""),
        F.when(
            body.rlike(r"\(\s*+\*"), F.array_join(F.regexp_extract_all(body, F.lit(_LOCAL_FN_POINTER), F.lit(1)), " ")
        ).otherwise(""),
    )
    return F.octet_length(pointers) - F.octet_length(F.replace(pointers, F.lit("*"), F.lit("")))


def either_pointers(body: Column) -> Column:
    """Statements of a cleaned body that declare pointers only if a name is a type: ``array<struct<name,stars>>``."""
    found = F.regexp_extract_all(body, F.lit(_EITHER), F.lit(1))
    return F.transform(
        found,
        lambda m: F.struct(
            F.regexp_extract(m, rf"\A{IDENT}", 0).alias("name"),
            F.regexp_count(F.regexp_replace(m, _INITIALISER, ""), F.lit(r"\*")).alias("stars"),
        ),
    )


def type_names(clean: Column) -> Column:
    """Names that a cleaned file defines by ``typedef`` or uses as types without doubt, each once."""
    typedefs = F.regexp_extract_all(clean, F.lit(_TYPEDEF), F.lit(1))

    def defined(text: Column) -> Column:
        pointers = F.regexp_extract_all(text, F.lit(rf"\(\s*+\*[\s*]*+({IDENT})\s*+\)\s*+\("), F.lit(1))
        plain = F.regexp_replace(F.regexp_replace(text, rf"{_BRACES}|{_INDEX}", " "), _GROUP, " ")
        last = F.transform(F.split(plain, ","), lambda d: F.regexp_extract(d, rf"({IDENT})\s*+\z", 1))
        return F.when(F.size(pointers) > 0, F.slice(pointers, 1, 1)).otherwise(last)

    used = [F.regexp_extract_all(clean, F.lit(p), F.lit(1)) for p in (_POINTER_CAST, _PLAIN_DECLARATION, _POINTER_PARAMETER)]
    names = F.concat(F.flatten(F.transform(typedefs, defined)), *used)
    return F.array_distinct(F.filter(names, lambda n: (n != "") & ~n.isin(NON_CALL_WORDS)))


def declares_variable(clean: Column, name: Column) -> Column:
    """Whether a cleaned definition declares a variable or parameter ``name``."""
    before = rf"\b(?!(?:return|goto|else|case|sizeof)\b){IDENT}(?:\s++|\s*+\*[\s*]*+)"
    pattern = F.concat(F.lit(before), name, F.lit(r"\s*+[;=,\[)]"))
    return F.call_function("rlike", clean, pattern)


def line_count(code: Column) -> Column:
    return F.octet_length(code) - F.octet_length(F.replace(code, F.lit("\n"), F.lit(""))) + 1


# Depths that a pattern tells before brackets are counted one by one.
_ROUNDS = 12


def brackets(clean: Column) -> Column:
    """The brackets of a cleaned definition, of any kind, as round ones."""
    only = F.regexp_replace(clean, r"[^\[\](){}]+", "")
    for other, alike in (("[", "("), ("{", "("), ("]", ")"), ("}", ")")):
        only = F.replace(only, F.lit(other), F.lit(alike))
    return only


def nesting_depth(clean: Column) -> Column:
    """Greatest depth of open brackets of any kind in a cleaned definition."""
    return _once(brackets(clean), bracket_depth)


def bracket_depth(only: Column) -> Column:
    """Greatest depth of open round brackets in a text of such brackets."""
    depth = _counted_depth(only)
    for n in reversed(range(1, _ROUNDS + 1)):
        depth = F.when(only.rlike(_closed_brackets(n)), F.lit(n)).otherwise(depth)
    return F.when(only == "", F.lit(0)).otherwise(depth)


def _closed_brackets(depth: int) -> str:
    """Pattern of brackets that close and nest at most ``depth`` levels."""
    pattern = r"\(\)"
    for _ in range(depth - 1):
        pattern = rf"\((?:{pattern})*+\)"
    return rf"\A(?:{pattern})*+\z"


def _counted_depth(brackets: Column) -> Column:
    """Greatest number of brackets open at once in a text of round brackets, whether or not they balance."""
    zero = F.expr("named_struct('depth',0,'most',0)").cast("struct<depth:int,most:int>")

    def step(state: Column, bracket: Column) -> Column:
        depth = state["depth"] + F.when(bracket == "(", 1).otherwise(-1)
        return F.struct(depth.alias("depth"), F.greatest(state["most"], depth).alias("most")).cast(
            "struct<depth:int,most:int>"
        )

    return F.aggregate(F.regexp_extract_all(brackets, F.lit("[()]"), F.lit(0)), zero, step, lambda state: state["most"])
