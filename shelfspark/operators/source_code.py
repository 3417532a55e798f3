"""Functions and calls of source files in Kotlin, Java, JavaScript and TypeScript.

A file is read in two steps. A lexer with a stack of states (code, strings, raw
strings, templates, comments) blanks whatever is no code; code inside a template
stays, and nothing changes its place. Then brackets of what is left are paired
and functions and calls are told by the tokens around them. There is no grammar
behind it: what a compiler would reject may be read either way.

Which function a call lies in is found for all files at once, by one sort of
begins, ends and calls in each file.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Endings of files that are read, by language.
ENDINGS = {"kotlin": ("kt", "kts"), "java": ("java",), "js": ("js", "jsx", "mjs"), "ts": ("ts", "tsx", "mts")}
LANGUAGES = {e: lang for lang, ends in ENDINGS.items() for e in ends}

# -- what is code ------------------------------------------------------------------

_PLAIN = {
    "kotlin": re.compile(r'//|/\*|"""|"|\'(?:\\.|[^\'\\\n])+\'|[{}]'),
    "java": re.compile(r'//|/\*|"""|"|\'(?:\\.|[^\'\\\n])+\'|[{}]'),
    "js": re.compile(r"//|/\*|[\"'`/{}]"),
}
_PLAIN["ts"] = _PLAIN["js"]
_COMMENT, _NESTED = re.compile(r"\*/"), re.compile(r"/\*|\*/")
#: What ends a string or opens code inside it, by the sign it began with and whether it has templates.
_INSIDE = {
    ('"', True): re.compile(r'\\.|\$\{|"|\n', re.S),
    ('"', False): re.compile(r'\\.|"|\n', re.S),
    ("'", False): re.compile(r"\\.|'|\n", re.S),
    ('"""', True): re.compile(r'\$\{|"""+'),
    ('"""', False): re.compile(r'\\.|"""', re.S),
    ("`", True): re.compile(r"\\.|\$\{|`", re.S),
}
_REGEX = re.compile(r"/(?:\\.|\[(?:\\.|[^\]\\\n])*\]|[^/\\\[\n])+/[a-z]*")
#: A slash after these begins a regular expression.
_BEFORE_REGEX = re.compile(r"(?:^|[(,=:\[!&|?{};+*%<>~^-]|\b(?:return|typeof|case|in|of|do|else|void|delete))\s*\Z")


def only_code(text: str, language: str) -> str:
    """``text`` with comments and strings blanked, of equal length and with the same lines; a string leaves its first quote."""
    out, at, n = [], 0, len(text)
    plain, templates = _PLAIN[language], language != "java"
    #: Kinds of strings whose templates are open, each with the braces opened in it.
    stack: list[list] = []

    def blank(lo: int, hi: int, keep: str = "") -> None:
        out.append(keep + "\n".join([" " * len(x) for x in text[lo + len(keep) : hi].split("\n")]))

    def string(kind: str, lo: int, begun: int) -> int:
        """Blanks a string from ``lo``, its inside from ``begun``, up to its end or a template in it."""
        inside = _INSIDE[kind, templates and kind in ('"', '"""', "`")]
        keep = '"' if begun > lo and text[lo] in "\"'`" else ""
        at = begun
        while m := inside.search(text, at):
            at = m.end()
            if m[0][0] == "\\":
                continue
            if m[0] == "${":
                stack.append([kind, 0])
            blank(lo, at, keep)
            return at
        blank(lo, n, keep)
        return n

    while m := plain.search(text, at):
        lo, sign = m.start(), m[0]
        out.append(text[at:lo])
        if sign == "//":
            at = text.find("\n", lo)
            at = n if at < 0 else at
            blank(lo, at)
        elif sign == "/*":
            at, deep = lo + 2, 1
            while deep:
                end = (_NESTED if language == "kotlin" else _COMMENT).search(text, at)
                at = end.end() if end else n
                deep = deep + (1 if end[0] == "/*" else -1) if end else 0
            blank(lo, at)
        elif sign in ('"""', '"', "`") or sign == "'":
            at = string(sign, lo, m.end())
        elif sign[0] == "'":
            blank(lo, m.end(), '"')
            at = m.end()
        elif sign == "/":
            rx = _REGEX.match(text, lo)
            if rx and _BEFORE_REGEX.search(text[max(0, lo - 40) : lo]):
                blank(lo, rx.end(), "")
                at = rx.end()
            else:
                out.append("/")
                at = lo + 1
        elif sign == "}" and stack and not stack[-1][1]:
            at = string(stack.pop()[0], lo, lo + 1)
        else:
            if stack:
                stack[-1][1] += 1 if sign == "{" else -1
            out.append(sign)
            at = lo + 1
    out.append(text[at:])
    return "".join(out)


# -- functions and calls -------------------------------------------------------------

_TOKEN = re.compile(r"`[^`\n]+`|[A-Za-z_$\u0080-\U0010ffff][\w$]*|\d[\w.]*|=>|->|\?\.|\?:|::|!!|&&|\|\||[-+*/%=!<>]=|[^\s\w]")
#: A sign where a token may begin; what is blanked is passed over in one search.
_SIGN = re.compile(r"[^\t-\r\x1c-\x20]")
_NAME = re.compile(r"[`A-Za-z_$\u0080-\U0010ffff]")
_PAIRS = {")": "(", "]": "[", "}": "{"}
#: No call and no name of a function, by language.
_WORDS = {
    "kotlin": frozenset("if for while when catch return throw try else do in is as fun val var class interface object typealias init constructor get set by where finally break continue null true false package import".split()),
    "java": frozenset("if for while switch catch return throw try else do synchronized assert case new instanceof class interface enum record super this finally break continue import package extends implements throws default".split()),
    "js": frozenset("if for while switch catch return throw try else do with function new typeof instanceof in of void delete await yield case class extends super import export default const let var finally break continue".split()),
}
_WORDS["ts"] = _WORDS["js"] | {"interface", "enum", "namespace", "declare", "keyof"}
_MODIFIERS = {
    "kotlin": frozenset("public private protected internal override open abstract final suspend inline tailrec operator infix external expect actual const".split()),
    "js": frozenset("async static get set public private protected readonly override abstract declare".split()),
}
_MODIFIERS["ts"] = _MODIFIERS["js"]
#: An expression goes on in the next line after, or before, one of these.
_GOES_ON_AFTER = frozenset(". ?. :: ?: = => -> + - * / % && || & | ^ < > ! ? : , ( [ { == != <= >= += -= in as is instanceof new await return throw".split())
_GOES_ON_BEFORE = frozenset(". ?. :: ?: + * / % && || & | ^ ? : == != <= >= = else as is in instanceof ) ] } ,".split())


def _tokens(clean: str) -> Iterator[re.Match]:
    at = 0
    while sign := _SIGN.search(clean, at):
        if m := _TOKEN.match(clean, sign.start()):
            yield m
        at = m.end() if m else sign.end()


class Code:
    """Tokens of a file with their places, lines and partners of brackets."""

    def __init__(self, text: str, language: str):
        self.text, self.language, self.words = text, language, _WORDS[language]
        clean = only_code(text, language)
        found = list(_tokens(clean))
        self.t = [m[0] for m in found]
        self.begin, self.stop = [m.start() for m in found], [m.end() for m in found]
        breaks = [m.start() for m in re.finditer("\n", text)]
        self.line = [bisect_right(breaks, p - 1) + 1 for p in self.begin]
        self.n = len(self.t)
        self.partner: dict[int, int] = {}
        opened: list[int] = []
        for k, x in enumerate(self.t):
            if x in "([{":
                opened.append(k)
            elif x in _PAIRS:
                while opened and self.t[opened[-1]] != _PAIRS[x] and _PAIRS[x] in (self.t[o] for o in opened[-8:]):
                    opened.pop()
                if opened and self.t[opened[-1]] == _PAIRS[x]:
                    o = opened.pop()
                    self.partner[o], self.partner[k] = k, o

    def at(self, k: int) -> str:
        return self.t[k] if 0 <= k < self.n else ""

    def is_name(self, k: int) -> bool:
        return bool(_NAME.match(self.at(k))) and (self.at(k) not in self.words or self.at(k - 1) in (".", "?."))

    def new_line(self, k: int) -> bool:
        return k > 0 and self.line[k] > self.line[k - 1]

    def before_angle(self, k: int) -> int:
        """The token before the ``<`` that the ``>`` at ``k`` closes, or -1 if it is no list of types."""
        deep = 0
        while k >= 0:
            x = self.t[k]
            if x == ">":
                deep += 1
            elif x == "<":
                deep -= 1
                if not deep:
                    return k - 1
            elif not (_NAME.match(x) or x in ",.?&[]*@"):
                return -1
            k -= 1
        return -1

    def expression_end(self, k: int) -> int:
        """Last token of the expression that begins at ``k``."""
        first = k
        while k < self.n:
            x = self.t[k]
            if k > first and (x in ")]},;" or (self.new_line(k) and x not in _GOES_ON_BEFORE and self.t[k - 1] not in _GOES_ON_AFTER)):
                break
            k = self.partner.get(k, k) + 1 if x in "([{" else k + 1
        return max(first, k - 1)

    def type_end(self, k: int) -> int:
        """First token after a type that begins at ``k``: a body, a sign of equality, or what begins another line."""
        first = k
        while k < self.n and self.t[k] not in ("{", "=", ";", ")", "}", "=>"):
            if k > first and self.new_line(k) and self.t[k] not in (":", ".", "->", "where", ",") and self.t[k - 1] not in (":", ".", "->", ",", "<", "where"):
                break
            k = self.partner.get(k, k) + 1 if self.t[k] in "([" else k + 1
        return k

    def with_modifiers(self, k: int) -> int:
        """First of the modifiers and annotations before ``k``."""
        while k > 0:
            j = self.partner.get(k - 1, -1) - 1 if self.at(k - 1) == ")" else k - 1
            if self.at(k - 1) in _MODIFIERS.get(self.language, ()):
                k -= 1
                continue
            while j > 1 and self.at(j - 1) in (".", ":") and _NAME.match(self.at(j - 2)):
                j -= 2
            if j > 0 and _NAME.match(self.at(j)) and self.at(j - 1) == "@":
                k = j - 1
                continue
            break
        return k


Span = tuple[str, int, int]


def _kotlin_functions(c: Code) -> Iterator[tuple[Span, int]]:
    for k in range(c.n):
        if c.t[k] != "fun" or c.at(k + 1) in ("(", "interface") or c.at(k - 1) in (".", "::"):
            continue
        j, angle = k + 1, 0
        while j < c.n and (angle or c.t[j] != "(" or not _NAME.match(c.t[j - 1])):  # past type parameters and a receiver
            angle += (c.t[j] == "<") - (c.t[j] == ">")
            if c.t[j] in "{};=":
                break
            j += 1
        if c.at(j) != "(" or j not in c.partner:
            continue
        body = c.type_end(c.partner[j] + 1)
        end = c.partner.get(body, c.n - 1) if c.at(body) == "{" else c.expression_end(body + 1) if c.at(body) == "=" else body - 1
        yield (c.t[j - 1].strip("`"), c.with_modifiers(k), min(end, c.n - 1)), j


def _holds_members(c: Code, brace: int) -> bool:
    """Does the brace open the body of a class or interface, named or not?"""
    k = brace - 1
    if c.at(k) == ")" and k in c.partner:
        k = c.partner[k] - 1
        k = c.before_angle(k) if c.at(k) == ">" else k
        while c.at(k - 1) == "." and _NAME.match(c.at(k - 2)):
            k -= 2
        if c.at(k - 1) == "new":
            return True
        k = brace - 1
    while k >= 0 and c.t[k] not in ("{", "}", ";"):
        if c.t[k] in ("class", "interface", "enum", "record") and c.at(k - 1) != ".":
            return True
        k = c.partner[k] - 1 if c.t[k] in ")]" and k in c.partner else k - 1
    return False


def _java_functions(c: Code) -> Iterator[tuple[Span | None, int]]:
    braces: list[bool] = []
    for k in range(c.n):
        if c.t[k] == "{":
            braces.append(_holds_members(c, k))
        elif c.t[k] == "}" and braces:
            braces.pop()
        elif c.t[k] == "(" and k in c.partner and c.is_name(k - 1) and braces and braces[-1]:
            after = c.partner[k] + 1
            while c.at(after) == "[" and c.at(after + 1) == "]":
                after += 2
            if c.at(after) == "throws":
                while c.at(after) not in ("{", ";", ""):
                    after += 1
            if c.at(after) not in ("{", ";", "default"):
                continue
            typed = c.at(k - 2) in (">", "]") or (bool(_NAME.match(c.at(k - 2))) and c.at(k - 2) not in c.words | {"public", "private", "protected", "static", "final", "abstract", "synchronized", "native", "default"} and c.at(k - 3) != "@")
            begin = k - 1
            while begin > 0 and c.t[begin - 1] not in ("{", "}", ";"):
                begin = c.partner.get(begin - 1, begin - 1) if c.t[begin - 1] in ")]" else begin - 1
            end = c.partner.get(after, c.n - 1) if c.at(after) == "{" else after
            if typed:
                yield (c.t[k - 1], begin, min(end, c.n - 1)), k
            elif c.at(after) == "{":  # a constructor is no function, and no call
                yield None, k


def _script_functions(c: Code) -> Iterator[tuple[Span, int]]:
    typed = c.language == "ts"
    for k in range(c.n):
        x = c.t[k]
        if x == "function" and c.at(k - 1) != ".":
            name = k + 1
            if not c.is_name(name):
                continue
            open_ = name + 1
            while c.at(open_) not in ("(", "{", ""):
                open_ += 1
            shown = c.at(k - 1) == "async" and c.at(k - 2) or c.at(k - 1)
            if c.at(open_) == "(" and open_ in c.partner and shown not in ("=", "(", ",", ":", "?", "&&", "||", "!", "[", "return", "=>", "new", "+", "await"):
                body = c.type_end(c.partner[open_] + 1)
                begin = k - 1 if c.at(k - 1) == "async" else k
                yield (c.t[name], begin, c.partner.get(body, c.n - 1) if c.at(body) == "{" else body - 1), open_
            elif c.at(open_) == "(":
                yield None, open_
        elif x == "=>":
            begin, name = k - 1, ""
            if c.at(begin) != ")" and not (c.is_name(begin) and c.at(begin - 1) not in (":", ">", "]", ".", "|", "&")):
                while begin > 0 and c.t[begin] not in (":", "=", ";", "{", ","):  # back over the type that is given back
                    begin -= 1
                begin = begin - 1 if c.at(begin) == ":" and c.at(begin - 1) == ")" else k - 1
            if c.at(begin) == ")":
                begin = c.partner.get(begin, begin)
            elif c.is_name(begin):
                name = c.t[begin]
            if typed and c.at(k + 1) != "{" and (c.at(begin - 1) in (":", "|") or (c.at(begin - 1) == "=" and c.at(begin - 3) == "type")):
                continue
            end = c.partner.get(k + 1, c.n - 1) if c.at(k + 1) == "{" else c.expression_end(k + 1)
            if not name and end == k + 1 and c.is_name(end):
                name = c.t[end]
            begin = begin - 1 if c.at(begin - 1) == "async" else begin
            yield (name, begin, min(end, c.n - 1)), begin
        elif x == "(" and k in c.partner and (c.is_name(k - 1) or c.at(k - 1) in ("get", "set", "static", "of", "default", "delete", "in")):
            body = c.partner[k] + 1
            if typed and c.at(body) == ":":
                body = c.type_end(body + 1)
            begin = k - 1
            if c.at(begin - 1) == "#":
                begin -= 1
            while c.at(begin - 1) in _MODIFIERS["js"] or c.at(begin - 1) == "*":
                begin -= 1
            if c.at(body) == "{" and c.at(begin - 1) in ("{", "}", ";", ",", "") and c.at(k - 1) not in c.words - {"default", "delete", "of", "in"} and not c.new_line(body):
                yield (("#" if c.at(k - 2) == "#" else "") + c.t[k - 1], c.with_modifiers(begin), c.partner.get(body, c.n - 1)), k


_FUNCTIONS = {"kotlin": _kotlin_functions, "java": _java_functions, "js": _script_functions, "ts": _script_functions}


def _chain_begin(c: Code, k: int) -> int:
    """First token of the chain of names, calls and brackets that ends with the name at ``k``."""
    while c.at(k - 1) in (".", "?.", "::"):
        j = k - 2
        while c.at(j) in ("!!", "!"):
            j -= 1
        while True:
            if c.at(j) in (")", "]", "}") and j in c.partner and not (c.at(j) == "}" and c.language != "kotlin"):
                was = c.at(j)
                j = c.partner[j] - 1
                if c.at(j) == ">":
                    j = max(c.before_angle(j), -1) if c.before_angle(j) >= 0 else j
                if not (c.is_name(j) or c.at(j) in (")", "]", "super", "this")):
                    return j + 1 if was != "}" else k
                continue
            break
        if not (_NAME.match(c.at(j)) or c.at(j) == '"' or c.at(j)[:1].isdigit()):
            return k
        k = j
        if c.t[k] in c.words and c.t[k] not in ("this", "super"):
            return k + 2
    return k


def _calls(c: Code, heads: set[int]) -> Iterator[tuple[int, int, str]]:
    """(first token, token of the bracket, called name as written) of every call."""
    lambdas = c.language == "kotlin"
    for k in range(1, c.n):
        x = c.t[k]
        if (x != "(" and not (lambdas and x == "{")) or k in heads:
            continue
        j = k - 1
        if c.at(j) == ">" and c.language != "java":
            j = c.before_angle(j)
        elif c.at(j) == ">":
            j = c.before_angle(j)
        if j < 0 or not c.is_name(j) or (c.new_line(k) and x == "("):
            continue
        if x == "{" and (c.at(j - 1) in (":", "class", "object", "interface", "companion", "fun", "->", "as", "is", ",", ">", "enum") or c.at(j) in ("companion", "object", "init", "get", "set", "else", "try", "do", "finally")):
            continue
        begin = _chain_begin(c, j)
        lead = c.at(begin - 1)
        if lead == "@" or (lambdas and (lead in (":", "constructor", "class", "fun") or c.at(j) == "constructor")):
            continue
        if x == "{" and lead in (":", "class", "object", "interface"):
            continue
        if lead == "new":
            plain = not any(y in ")]" for y in c.t[begin:j])
            if c.language != "java":
                if plain:
                    continue
            elif plain:
                yield begin - 1, k, c.text[c.begin[begin] : c.begin[k]].strip()
                continue
            begin -= 1
        stop = c.stop[j] if c.language != "kotlin" else c.begin[k]
        callee = c.text[c.begin[begin] : stop]
        yield begin, k, (callee.split("(", 1)[0] if c.language == "kotlin" else callee).strip()


_MENTION = re.compile(r"[A-Za-z0-9_$]+(?=\()")


def _mentions(text: str) -> list[dict]:
    """Names before a bracket, in small letters, that stand first in a line or behind a dot, space, bracket or sign of equality at their first place in it."""
    out, at, n = [], 0, 1
    k = text.find("(")
    while k >= 0:  # only lines with a bracket are read
        before, stop = text.rfind("\n", at, k), text.find("\n", k)
        begin, stop = before + 1 if before >= 0 else at, stop if stop >= 0 else len(text)
        n += text.count("\n", at, begin)
        low = text[begin:stop].lower()
        for name in dict.fromkeys(_MENTION.findall(low)):
            i = low.index(name + "(")
            if i == 0 or low[i - 1] in ". \t(=":
                out.append({"line": n, "at": begin + i, "called": name})
        at, k = stop, text.find("(", stop)
    return out


def read_code(text: str | None, path: str | None) -> dict | None:
    """Functions, calls and mentions of a file; none if its ending names no language that is read."""
    _, dot, ending = (path or "").rsplit("/", 1)[-1].rpartition(".")
    language = LANGUAGES.get(ending.lower()) if dot else None
    if language is None or text is None:
        return None
    c = Code(text, language)
    functions, heads = [], set()
    for span, head in _FUNCTIONS[language](c):
        heads.add(head)
        if span is not None and span[1] <= span[2]:
            name, lo, hi = span
            functions.append({"name": name, "begin": c.line[lo], "stop": c.line[hi], "begin_at": c.begin[lo], "stop_at": c.stop[hi]})
    calls = [{"line": c.line[lo], "at": c.begin[k], "order": n, "callee": callee} for n, (lo, k, callee) in enumerate(sorted(_calls(c, heads), key=lambda x: (x[0], -x[1])))]
    return {"functions": sorted(functions, key=lambda f: (f["begin_at"], -f["stop_at"])), "calls": calls, "mentions": _mentions(text)}


def _structs(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


_INT, _STRING = T.IntegerType(), T.StringType()
_CODE = T.StructType([
    T.StructField("functions", _structs(name=_STRING, begin=_INT, stop=_INT, begin_at=_INT, stop_at=_INT)),
    T.StructField("calls", _structs(line=_INT, at=_INT, order=_INT, callee=_STRING)),
    T.StructField("mentions", _structs(line=_INT, at=_INT, called=_STRING)),
])


#: Files whose findings are held and sent on together.
FILES_A_BATCH = 64


def _read(names: list[str]):
    """Batches of (tree, path, body) -> (tree, path, functions, calls, mentions), a few files at a time."""
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in _CODE.fields]
    nothing = {name: [] for name, _ in kinds}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, FILES_A_BATCH):
                part = batch.slice(lo, FILES_A_BATCH)
                found = [read_code(b.as_py(), p.as_py()) or nothing for b, p in zip(part.column(2), part.column(1), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array([f[name] for f in found], kind) for name, kind in kinds]], names=names)

    return run


def has_grammar(path: Column) -> Column:
    """Does the ending of a path name a language whose functions and calls are read?"""
    return F.lower(F.substring_index(path, ".", -1)).isin(*LANGUAGES) & F.contains(F.substring_index(path, "/", -1), F.lit("."))


def parsed(files: DataFrame, tree: str = "tree_id", path: str = "path", body: str = "body") -> DataFrame:
    """(tree, path, functions, calls, mentions) of the files whose language is read.

    A function has its name, first and last line and places of its first and
    last sign; a call its line, place and called name as written, in the order
    of the text, outer calls before those inside them. A mention is a name
    before a bracket anywhere in a line. Null bodies and other endings give no
    row; equal rows are read alike.
    """
    known = files.filter(has_grammar(F.col(path)) & F.col(body).isNotNull()).select(tree, path, body)
    out = T.StructType([*known.schema.fields[:2], *_CODE.fields])
    return known.mapInArrow(_read(out.names), out)


def functions_of(code: DataFrame, tree: str = "tree_id") -> DataFrame:
    return code.select(tree, "path", F.inline("functions"))


def calls_of(code: DataFrame, tree: str = "tree_id") -> DataFrame:
    return code.select(tree, "path", F.inline("calls"))


def enclosing(points: DataFrame, spans: DataFrame, keys: list[str], depth: int = 0) -> DataFrame:
    """``points`` (keys, at, ...) with ``span``, the span (keys, begin_at, stop_at, ...) around each, null outside of all.

    Spans of a key lie inside or beside one another. With ``depth`` 0 it is the
    innermost span, with 1 the outermost, with 2 the one inside that (null if
    there is none). Begins, ends and points of a key are sorted once: the running
    count of open spans is the depth, and the span around a point is the last
    that began at its depth. No pair of a point and a span that doesn't hold it
    is formed. A point where a span begins is inside, one where it stops is not.
    """
    rest = [c for c in points.columns if c not in keys]
    spans = spans.filter("begin_at < stop_at")  # an empty span holds no point
    held = [c for c in spans.columns if c not in keys]
    span = F.struct(*held)
    none = F.lit(None).cast(spans.select(span.alias("s")).schema["s"].dataType)
    inner = F.struct(*[F.col(c) for c in rest])
    empty = F.lit(None).cast(points.select(inner.alias("p")).schema["p"].dataType)
    event = lambda df, at, rank, step, tie, s, p: df.select(*keys, F.col(at).alias("__at"), F.lit(rank).alias("__rank"), F.lit(step).alias("__step"), tie.cast("long").alias("__tie"), s.alias("__span"), p.alias("__point"))
    events = event(spans, "stop_at", 0, -1, -F.col("begin_at"), none, empty).unionByName(event(spans, "begin_at", 1, 1, -F.col("stop_at"), span, empty)).unionByName(event(points, "at", 2, 0, F.lit(0), none, inner))
    along = Window.partitionBy(*keys).orderBy("__at", "__rank", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    deep = events.withColumn("__open", F.sum("__step").over(along))
    if depth:
        deep = deep.withColumn("__level", F.when(F.col("__point").isNotNull(), F.when(F.col("__open") >= depth, depth)).otherwise(F.col("__open")))
    else:
        deep = deep.withColumn("__level", F.when((F.col("__point").isNull()) | (F.col("__open") > 0), F.col("__open")))
    same = Window.partitionBy(*keys, "__level").orderBy("__at", "__rank", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    found = deep.filter("__span IS NOT NULL OR __point IS NOT NULL").withColumn("__last", F.when(F.col("__level").isNotNull(), F.last("__span", True).over(same)))
    return found.filter("__point IS NOT NULL").select(*keys, "__point.*", F.col("__last").alias("span"))
