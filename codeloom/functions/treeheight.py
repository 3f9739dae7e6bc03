"""Height of the syntax tree of a C function, by a fold over its tokens.

No tree is built: operators and brackets stand on a stack, and what they close leaves its height only. A leaf has
the height 0, a node one more than its highest child; brackets and separators are leaves. Operators nest by
precedence and associativity, a call holds its callee and its argument list, a statement its parts and its ``;``.
Words side by side, as in declarations, are siblings.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Binary operators of C by rising precedence.
_LEVELS = [
    ("=", "+=", "-=", "*=", "/=", "%=", "<<=", ">>=", "&=", "^=", "|="), ("?", ":"), ("||",), ("&&",), ("|",), ("^",), ("&",),
    ("==", "!="), ("<", ">", "<=", ">="), ("<<", ">>"), ("+", "-"), ("*", "/", "%"),
]
BINARY = {op: level for level, ops in enumerate(_LEVELS, 1) for op in ops}
RIGHT = {1, 2}
UNARY, MEMBER = len(_LEVELS) + 1, len(_LEVELS) + 3
PREFIX = {"*", "&", "!", "~", "+", "-", "++", "--", "sizeof", "_Alignof", "alignof"}
TYPE_WORDS = {"void", "char", "short", "int", "long", "float", "double", "signed", "unsigned", "bool", "_Bool", "struct", "union", "enum", "const", "volatile"}
HEADS = {"if", "while", "for", "switch"}

_TOKEN = re.compile(
    r"""\s+|//(?:\\[\s\S]|[^\n\\])*|/\*[\s\S]*?\*/|([A-Za-z_]\w*|[(){}\[\],;~?:]|\#(?:\\[\s\S]|[^\n\\])*"""
    r"""|"(?:\\[\s\S]|[^"\\\n])*"?|'(?:\\[\s\S]|[^'\\\n])*'?|\.?[0-9](?:[eEpP][+\-]|[\w.])*"""
    r"""|<<=|>>=|\.\.\.|->|\+\+|--|<<|>>|[-+*/%&|^=!<>]=|&&|\|\||[-+*/%&|^=!<>.])""",
)
# The tokens that are no leaves.
_SIGNS = frozenset(["<<=", ">>=", "...", "->", "++", "--", "<<", ">>", "&&", "||"] + [f"{c}=" for c in "-+*/%&|^=!<>"] + [*"-+*/%&|^=!<>~?:.,;(){}[]"])


class _Expression:
    """Operands and open operators between two brackets; ``best`` is the highest part before the last comma."""

    __slots__ = ("closes", "call", "operands", "operators", "wanted", "best", "is_type")

    def __init__(self, closes: str, call: bool = False):
        self.closes, self.call = closes, call
        self.operands: list[int] = []
        self.operators: list[tuple[int, int]] = []  # level, height that stands beside the operand
        self.wanted = True
        self.best = 0
        self.is_type = False

    def reduce(self, level: int) -> None:
        """Close the operators above ``level``, and those of it that associate to the left."""
        while self.operators:
            top, beside = self.operators[-1]
            if top < level or (top == level and top in RIGHT):
                return
            self.operators.pop()
            right = self.operands.pop() if self.operands else 0
            left = 0
            if top not in (UNARY,) and self.operands:
                left = self.operands.pop()
            self.operands.append(1 + max(left, right, beside))

    def end(self) -> int:
        if self.operators:
            self.reduce(0)
        while self.operators:  # assignments and conditions
            self.operators, rest = self.operators[:-1], self.operators[-1]
            right = self.operands.pop() if self.operands else 0
            left = self.operands.pop() if self.operands else 0
            self.operands.append(1 + max(left, right, rest[1]))
        if self.operands:
            self.best = max(self.best, max(self.operands))
            self.operands = []
        self.wanted = True
        return self.best

    def leaf(self, height: int = 0) -> None:
        if self.wanted or not self.operands:
            self.operands.append(height)
        else:
            self.operands[-1] = max(self.operands[-1], height)
        self.wanted = False

    def operator(self, op: str) -> None:
        if op in ("++", "--") and not self.wanted:
            self.reduce(MEMBER)
            self.operands[-1] += 1
        elif self.wanted and op in PREFIX:
            self.operators.append((UNARY, 0))
        elif op in (".", "->"):
            self.reduce(MEMBER)
            self.operators.append((MEMBER, 0))
            self.wanted = True
        elif op == ":":
            # The middle of a condition becomes a sibling of what follows.
            while self.operators and self.operators[-1][0] != BINARY["?"]:
                self.reduce(self.operators[-1][0] if self.operators[-1][0] not in RIGHT else 0)
                if self.operators and self.operators[-1][0] == 1:
                    self._close_last()
            if self.operators and self.operands:
                self.operators[-1] = BINARY["?"], max(self.operators[-1][1], self.operands.pop())
            self.wanted = True
        elif op in BINARY:
            level = BINARY[op]
            self.reduce(level)
            self.operators.append((level, 0))
            self.wanted = True

    def _close_last(self) -> None:
        _, beside = self.operators.pop()
        right = self.operands.pop() if self.operands else 0
        left = self.operands.pop() if self.operands else 0
        self.operands.append(1 + max(left, right, beside))


class _Block:
    """Statements between braces; ``case`` nests those that follow it."""

    __slots__ = ("best", "case")

    def __init__(self):
        self.best, self.case = 0, 0


class _Control:
    """A statement that waits for its condition, and then for the statement it governs."""

    __slots__ = ("word", "best", "governed")

    def __init__(self, word: str):
        self.word, self.best, self.governed = word, 0, False


def _tokens(code: str) -> list[tuple[str, bool]]:
    """Tokens and whether they are leaves, without comments and directives; of conditional parts the first branch."""
    found = _TOKEN.findall(code)  # empty for a comment and for blanks
    if "#" not in code:
        return [(token, token not in _SIGNS) for token in found if token]
    out, open_conditions, skipped = [], 0, 0
    for token in found:
        if token.startswith("#"):
            word = token[1:].lstrip()
            if word.startswith("if"):
                open_conditions += 1
            elif word.startswith("el") and not skipped:
                skipped = open_conditions
            elif word.startswith("endif"):
                skipped = 0 if skipped == open_conditions else skipped
                open_conditions = max(open_conditions - 1, 0)
        elif token and not skipped:
            out.append((token, token not in _SIGNS))
    return out


def height_of(code: str) -> int:
    """The height of the tree of one function definition; of a text without a body that of its words."""
    tokens = _tokens(code)
    head = _Expression("{")
    stack: list = [head]
    body = None
    n = len(tokens)
    i = 0

    def finished(height: int, following: str) -> None:
        """A statement is complete: so are the controls that waited for it, up to a block or an ``if`` with an ``else``."""
        while isinstance(stack[-1], _Control):
            control = stack[-1]
            control.best = max(control.best, height)
            if control.word == "if" and following == "else":
                control.word = "else"
                return
            if control.word == "do":
                control.word = "while after do"
                return
            stack.pop()
            # An else clause is a node between the statement and its if.
            height = 1 + (max(control.best, height + 1) if control.word == "else" else control.best)
        block = stack[-1]
        block.best = max(block.best, height + block.case)

    while i < n:
        token, is_leaf = tokens[i]
        following = tokens[i + 1][0] if i + 1 < n else ""
        i += 1
        top = stack[-1]
        if type(top) is not _Expression:
            if token == ";" and isinstance(top, _Control) and top.word == "while after do":
                stack.pop()
                finished(1 + top.best, following)
            elif token == "{":
                stack.append(_Block())
            elif token == "}":
                stack.pop()
                if not stack:
                    body = 1 + top.best
                    break
                finished(1 + top.best, following)
            elif token in HEADS and not (token == "while" and isinstance(top, _Control) and top.word == "while after do"):
                stack.append(_Control(token))
                if following == "(":
                    stack.append(_Expression(")"))
                    i += 1
            elif token == "while":  # of a do
                if following == "(":
                    stack.append(_Expression(")"))
                    i += 1
            elif token == "do":
                stack.append(_Control("do"))
            elif token == "else":
                pass
            elif token == "case" or token == "default" and following == ":":
                if isinstance(top, _Block):
                    top.case = 0
                stack.append(_Expression("case"))
            elif is_leaf and following == ":" and token not in TYPE_WORDS:
                # A label and its statement are one node.
                i += 1
                stack.append(_Control("label"))
            else:
                statement = _Expression(";")
                stack.append(statement)
                if token in ("return", "goto", "break", "continue"):
                    continue
                i -= 1
            continue
        # Inside an expression.
        if is_leaf and token not in PREFIX:
            top.is_type = top.is_type or token in TYPE_WORDS
            # Beside an operand a leaf adds no height.
            if top.wanted or not top.operands:
                top.operands.append(0)
            top.wanted = False
        elif token == "(" or token == "[":
            if not top.wanted:
                top.reduce(MEMBER)
            stack.append(_Expression(")" if token == "(" else "]", call=not top.wanted))
        elif token == ")" or token == "]":
            if top.closes != token:
                continue
            inner = top.end()
            stack.pop()
            outer = stack[-1]
            if isinstance(outer, _Control):
                outer.best = max(outer.best, 1 + inner)
                outer.governed = True
                continue
            if token == "]":
                base = outer.operands.pop() if outer.operands and top.call else 0
                outer.wanted = True
                outer.leaf(1 + max(base, inner))
            elif top.call:
                callee = outer.operands.pop() if outer.operands else 0
                outer.wanted = True
                outer.leaf(1 + max(callee, 1 + inner))
            else:
                after, after_leaf = tokens[i] if i < n else ("", False)
                if (after_leaf and outer is not head) or after in ("!", "~") or (top.is_type and after in PREFIX):
                    outer.operators.append((UNARY, 1 + inner))
                else:
                    outer.leaf(1 + inner)
        elif token == "{":
            if top is head:
                header = head.end()
                stack[:] = [_Block()]
                continue
            stack.append(_Expression("}", call=not top.wanted))
        elif token == "}":
            inner = top.end()
            if top.closes == "}":
                stack.pop()
                outer = stack[-1]
                if top.call and outer.operands:
                    outer.operands[-1] = 1 + max(outer.operands[-1], 1 + inner)
                else:
                    outer.leaf(1 + inner)
        elif token == ";":
            if top.closes in (";", "case"):
                height = 1 + top.end()
                stack.pop()
                finished(height, following)
            else:  # in the head of a for, or between old-style parameters
                top.end()
        elif token == ",":
            top.end()
        elif token == ":" and top.closes == "case" and not any(level == BINARY["?"] for level, _ in top.operators):
            value = top.end()
            stack.pop()
            outer = stack[-1]
            if isinstance(outer, _Block):
                outer.best = max(outer.best, 1 + value)
                outer.case = 1
        elif token != "...":
            if token == "*" and following == ")":
                top.is_type = True
                if not top.wanted and top.operands:
                    top.operands[-1] = max(1, 1 + top.operands[-1])
                continue
            top.operator(token)
    if body is None:  # the text ends early: what is open ends with it
        if stack[0] is head:
            return head.end()
        body = 0
        for frame in reversed(stack):
            body = 1 + max(body, frame.end() if isinstance(frame, _Expression) else frame.best)
    return 1 + max(header, body)


def tree_height(code: Column) -> Column:
    """``height_of`` a function text, a batch at a time; null for null."""

    @F.pandas_udf("int")
    def heights(batch: pd.Series) -> pd.Series:
        return batch.map(height_of, na_action="ignore").astype("Int32")

    return heights(code)
