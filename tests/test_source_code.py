"""The scanner of source against written snippets and generated code whose functions and calls are known."""

import random

import pytest

from shelfspark.operators import sinks, source_code
from shelfspark.operators.source_code import LANGUAGES, only_code, read_code

KOTLIN = '''package a.b
class A(val x: Int) : WebSocketListener(), B by c(x) {
  @Volatile override suspend fun <T> List<T>.ping(a: Int = f(1)): Map<String, (Int) -> Unit> {
    client.post("x ${androidId.foo("}")} \\" fun no() {") // fun comment() { call()
    /* outer /* inner */ fun hidden() { } */
    okhttp.newCall(req(1)).enqueue(object : Callback { override fun onFailure(e: Int) { log(e) } })
    val s = """raw ${ deep({ inner(2) }) } fun x() {"""
    run { socket.send(1) }
    items.forEach { it -> http.get(it) }
  }
  fun short() = ping(3)
     .then { x -> y(x) }
  abstract fun none(): Int
  val z get() = compute()
  fun after() { 'a'; '}' }
}
'''
SCRIPT = '''export default async function load(a, b = {}) { const r = await fetch(`u${ join(a, `n${b}`) }/function x() {`); return r.json() }
const f = (x) => client.post(x)
const g = async y => { api.get(y) };
class K { constructor(a) { super(a) } static async up(x) { if (x) { http.post(x) } } get v() { return 1 } #p() {} }
const o = { run() { new WebSocket(u).send(1) }, h: function named() { return /fun(ction)? x\\(/.test(s) / 2 } };
a.b(c).d(e => e.f())
'''
JAVA = '''class L extends M {
  int x = foo(3);
  L(int a) { super(a); init(a); }
  @Override @X("a(b") public <T> List<T> up(int a, String b) throws E {
    new Thread(new Runnable() { public void run() { client.post(id); } }).start();
    if (a > b) { for (;;) { x(); } }
    return new ArrayList<String>();
  }
  void later(String s);
  enum Z { A, B; int q() { return 1; } }
}
'''
TYPED = '''const p = (x: number): Promise<void> => { return api.put(x) }
type F = (x: A) => void;
export class Q { private async go(a: string): Promise<Map<string, number>> { await this.http.get<string>(a) } }
function over(a: string): void { b<T>(a) }
'''


@pytest.mark.parametrize(
    ("path", "text", "functions", "calls"),
    [
        ("a.kt", KOTLIN, [("ping", 3, 10), ("onFailure", 6, 6), ("short", 11, 12), ("none", 13, 13), ("after", 15, 15)], [(2, "c"), (3, "f"), (4, "client.post"), (4, "androidId.foo"), (6, "okhttp.newCall"), (6, "okhttp.newCall"), (6, "req"), (6, "log"), (7, "deep"), (7, "inner"), (8, "run"), (8, "socket.send"), (9, "items.forEach"), (9, "http.get"), (11, "ping"), (11, "ping"), (12, "y"), (14, "compute")]),
        ("b.JS", SCRIPT, [("load", 1, 1), ("", 2, 2), ("y", 3, 3), ("constructor", 4, 4), ("up", 4, 4), ("v", 4, 4), ("#p", 4, 4), ("run", 5, 5), ("e", 6, 6)], [(1, "fetch"), (1, "join"), (1, "r.json"), (2, "client.post"), (3, "api.get"), (4, "http.post"), (5, "new WebSocket(u).send"), (5, "test"), (6, "a.b(c).d"), (6, "a.b"), (6, "e.f")]),
        ("x/c.java", JAVA, [("up", 4, 8), ("run", 5, 5), ("later", 9, 9), ("q", 10, 10)], [(2, "foo"), (3, "init"), (5, "new Thread(new Runnable() { public void run() { client.post(id); } }).start"), (5, "Thread"), (5, "Runnable"), (5, "client.post"), (6, "x"), (7, "ArrayList<String>")]),
        ("d.ts", TYPED, [("", 1, 1), ("go", 3, 3), ("over", 4, 4)], [(1, "api.put"), (3, "this.http.get"), (4, "b")]),
        ("e.kt", "", [], []),
        ("f.java", 'class A { /* open', [], []),
        ("g.js", "`never ${closed(", [], [(1, "closed")]),
        ("h.kt", '"line\nf()\n""" ${ g() ', [], [(2, "f"), (3, "g")]),
    ],
)
def test_written_snippets(path, text, functions, calls):
    got = read_code(text, path)
    assert [(f["name"], f["begin"], f["stop"]) for f in got["functions"]] == functions
    assert [(c["line"], c["callee"]) for c in got["calls"]] == calls
    clean = only_code(text, LANGUAGES[path.rpartition(".")[2].lower()])
    assert len(clean) == len(text) and [k for k, x in enumerate(clean) if x == "\n"] == [k for k, x in enumerate(text) if x == "\n"]


def test_other_endings_are_not_read():
    assert read_code("fun a() {}", "a.dart") is None and read_code("fun a() {}", "kt") is None and read_code(None, "a.kt") is None and read_code("x", None) is None


class Writer:
    """Writes random code of a language and notes the functions and calls in it, with the function around each call."""

    def __init__(self, language: str, seed: int):
        self.language, self.rnd, self.out, self.line, self.n = language, random.Random(seed), [], 1, 0
        self.functions, self.calls = [], []

    def put(self, text: str) -> None:
        self.out.append(text)
        self.line += text.count("\n")

    def name(self) -> str:
        self.n += 1
        return f"n{self.n}{self.rnd.choice('abc')}"

    def noise(self) -> None:
        said = self.rnd.choice(["fun no() { x() }", "} ) ]", "function q(", "a() => {", "don't(", '{"('])
        quoted = said.replace('"', "")
        forms = [f"// {said}\n", f"/* {said}\n{said} */ ", f'val_ = "{quoted}";\n']
        if self.language == "kotlin":
            forms += [f'val v = """{quoted}\n"""\n', f"/* a /* {said} */ b */ "]
        if self.language in ("js", "ts"):
            forms += [f"const w = `{said}\n`;\n", f"const r = /x{{2}}[/(\"']\\)/g;\n"]
        self.put(self.rnd.choice(forms))

    def call(self, inside: int | None) -> None:
        name = ".".join(self.name() for _ in range(self.rnd.randint(1, 3)))
        self.calls.append((self.line, name, inside))
        nested = self.rnd.random()
        self.put(name + "(")
        if nested < 0.3:
            inner = self.name()
            self.calls.append((self.line, inner, inside))
            self.put(f"{inner}(1, (2))")
        elif nested < 0.4:
            self.put('"a) fun x() {"')
        elif nested < 0.5 and self.language in ("js", "ts", "kotlin"):
            inner, q = self.name(), "`" if self.language != "kotlin" else '"'
            self.put(f"{q}t ")
            self.put("${")
            self.calls.append((self.line, inner, inside))
            self.put(inner + "({ a() }) }" + f" ( {q}") if self.language != "kotlin" else self.put(inner + "(3) }" + f" ( {q}")
            if self.language != "kotlin":
                self.calls.append((self.line, "a", inside))
        self.put(")")
        self.put(";\n")

    def function(self, deep: int, inside: int | None, member: bool) -> None:
        me, name, begin = len(self.functions), self.name(), self.line
        kind = "plain"
        if self.language == "kotlin":
            head = self.rnd.choice(["fun ", "private suspend fun ", "override fun "]) + name + self.rnd.choice(["() ", "(a: Int, b: Map<String, Int>): List<Int> "])
        elif self.language == "java":
            head = self.rnd.choice(["public void ", "static <T> List<T> ", "int[] "]) + name + self.rnd.choice(["() ", "(int a, String b) throws E "])
        elif member:
            head = self.rnd.choice(["", "async ", "static "]) + name + "(a, b) "
        else:
            kind = self.rnd.choice(["plain", "arrow"])
            head = f"function {name}(a, b) " if kind == "plain" else f"const {name} = (a, b) => "
        self.functions.append(None)
        self.put(head + "{\n")
        self.body(deep + 1, me)
        self.put("}")
        self.functions[me] = ("" if kind == "arrow" else name, begin, self.line)
        self.put(";\n" if kind == "arrow" else "\n")

    def body(self, deep: int, inside: int | None) -> None:
        for _ in range(self.rnd.randint(0, 4)):
            what = self.rnd.random()
            if what < 0.35:
                self.call(inside)
            elif what < 0.6:
                self.noise()
            elif what < 0.75 and deep < 4:
                self.put("if (x > 1) {\n")
                self.body(deep + 1, inside)
                self.put("}\n")
            elif deep < 4 and self.language != "java":
                self.function(deep, inside, False)

    def file(self) -> str:
        for _ in range(self.rnd.randint(1, 4)):
            self.put(f"class {self.name()} {{\n")
            for _ in range(self.rnd.randint(0, 3)):
                self.function(0, None, True)
            self.put("}\n")
            if self.language != "java":
                self.body(0, None)
        return "".join(self.out)


@pytest.mark.parametrize("ending", ["kt", "java", "js", "ts"])
def test_generated_code_gives_its_functions_and_calls(ending):
    for seed in range(150):
        w = Writer(LANGUAGES[ending], seed)
        text = w.file()
        got = read_code(text, f"a.{ending}")
        assert sorted((f["name"], f["begin"], f["stop"]) for f in got["functions"]) == sorted(w.functions), text
        assert sorted((c["line"], c["callee"]) for c in got["calls"]) == sorted((line, name) for line, name, _ in w.calls), text


def test_calls_lie_in_their_innermost_function(spark):
    files, want = [], []
    for seed in range(40):
        ending = ["kt", "java", "js", "ts"][seed % 4]
        w = Writer(LANGUAGES[ending], 1000 + seed)
        files.append((seed % 3, f"f{seed}.{ending}", w.file()))
        want += [(f"f{seed}.{ending}", line, name, *(w.functions[k][:2] if k is not None else (None, None))) for line, name, k in w.calls]
    code = source_code.parsed(spark.createDataFrame(files, "tree_id int, path string, body string"))
    met = source_code.enclosing(source_code.calls_of(code), source_code.functions_of(code), ["tree_id", "path"]).collect()
    assert sorted(map(str, want)) == sorted(str((r.path, r.line, r.callee, r.span and r.span.name, r.span and r.span.begin)) for r in met)


def test_enclosing_spans_against_all_pairs(spark):
    rnd = random.Random(5)
    spans, points = [], []

    def nest(key, lo, hi, deep):
        while lo < hi - 1 and deep < 5:
            a = rnd.randint(lo, hi - 1)
            b = rnd.randint(a, hi)
            spans.append((key, a, b, len(spans)))
            nest(key, a, b, deep + 1)
            lo = b
            if rnd.random() < 0.4:
                return

    for key in (1, 2, None):
        nest(key, 0, 60, 0)
        points += [(key, rnd.randint(-3, 63), f"p{k}") for k in range(40)]
    points += points[:3]
    s = spark.createDataFrame(spans, "k int, begin_at int, stop_at int, id int")
    p = spark.createDataFrame(points, "k int, at int, what string")
    around = lambda key, at: sorted((x for x in spans if x[0] == key and x[1] <= at < x[2]), key=lambda x: (x[1], -x[2], x[3]))
    for depth in (0, 1, 2):
        got = sorted(str((r.k, r.at, r.what, r.span and (r.span.begin_at, r.span.stop_at))) for r in source_code.enclosing(p, s, ["k"], depth).collect())
        pick = lambda held: held[-1] if not depth and held else held[depth - 1] if depth and len(held) >= depth else None  # noqa: B023, E731
        assert got == sorted(str((k, at, what, (x := pick(around(k, at))) and x[1:3])) for k, at, what in points)


def test_sending_functions_their_callers_and_scores(spark):
    files = [
        ("t", "src/beacon.kt", "class A {\n  fun beacon() {\n    val id = androidId\n    client.post(id.toRequestBody())\n  }\n}\n"),
        ("t", "src/app.kt", "fun main() {\n  // beacon(\n  start()\n  beacon()\n}\n"),
        ("t", "src/aaa.js", 'function news() {\n  api.get("https://news.example.net/x")\n}\nclient.put(1)\n'),
        ("t", "src/place.ts", "class P { where() {\n  lm.getLastLocation()\n} }\n"),
        ("u", "src/app.kt", "fun other() {\n  beacon()\n}\n"),
    ]
    df = spark.createDataFrame(files, "tree_id string, path string, body string")
    code = source_code.parsed(df)
    got = {(r.path, r.fn): r for r in sinks.sink_groups(df, code).collect()}
    beacon, news, loose = got["src/beacon.kt", 12], got["src/aaa.js", 0], got["src/aaa.js", -1]
    assert len(got) == 3 and (beacon.score, news.score, loose.score) == (2 + 3, 1, 2)
    assert [(x.path, x.line, x.text) for x in beacon.lines] == [("src/beacon.kt", 2, "fun beacon() {"), ("src/beacon.kt", 3, "val id = androidId"), ("src/beacon.kt", 4, "client.post(id.toRequestBody())"), ("src/app.kt", 1, "fun main() {"), ("src/app.kt", 2, "// beacon("), ("src/app.kt", 3, "start()"), ("src/app.kt", 4, "beacon()")]
    assert [x.line for x in loose.lines] == [1, 2, 4]
    quoted = sinks.device_quotes(code, spark.createDataFrame([("t", "fine_location"), ("t", "camera"), ("u", "fine_location")], "tree_id string, fact string")).collect()
    assert [(r.tree_id, r.fact, r.score, r.path, r.a, r.b) for r in quoted] == [("t", "fine_location", 6, "src/place.ts", 0, 2)]
    lines = sinks.outbound(df, code, most=2).orderBy("pos").collect()
    assert [r.pos for r in lines] == list(range(1, len(lines) + 1)) and lines[0].path == "src/beacon.kt" and lines[-1].path == "src/aaa.js"


def test_a_recursive_function_is_not_its_own_caller(spark):
    files = [("t", "a.kt", "fun relay() {\n  client.post(1)\n  relay()\n  fun inside() {\n    relay()\n  }\n}\n"), ("t", "b.kt", "fun alone() {\n  client.post(1)\n  alone()\n}\n")]
    df = spark.createDataFrame(files, "tree_id string, path string, body string")
    code = source_code.parsed(df)
    calls = sinks.flagged_calls(code)
    got = sinks.callers(sinks.flagged_functions(calls), calls, code).collect()
    assert [(r.path, r.fn, r.caller_path, r.caller_line) for r in got] == [("a.kt", 0, "a.kt", 5)]


def test_long_functions_are_cut_around_the_send(spark):
    body = "fun far() {\n" + "x = 1\n" * 200 + "client.post(x)\n" + "y = 2\n" * 100 + "}\n"
    df = spark.createDataFrame([("t", "a.kt", body)], "tree_id string, path string, body string")
    r = sinks.sink_groups(df, source_code.parsed(df)).first()
    assert (r.lines[0].line, r.lines[-1].line, len(r.lines)) == (202 - 40, 202 - 40 + 120, 121)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "tree_id string, path string, body string")
    code = source_code.parsed(df)
    assert code.collect() == [] and sinks.outbound(df, code).collect() == []
