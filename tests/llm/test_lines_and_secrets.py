"""Site-relative line frequency and the secret scan, by brute force."""

import random
import re
from collections import Counter

from helpers import awkward, documents, prose
from pyspark.sql import functions as F

from wellspark.llm import boilerplate, secret_scan


def without_lines(rows, ratio, least):
    """The texts of (host, text) rows without the lines that are too frequent on their host."""
    pages, seen = Counter(), Counter()
    for host, text in rows:
        if host is not None:
            pages[host] += 1
            if text is not None:
                for line in {x.strip(" \t\r") for x in text.split("\n")} - {""}:
                    seen[host, line] += 1
    gone = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for host, text in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if host is None or (host, x.strip(" \t\r")) not in gone]
        out.append((host, None if text is None else "\n".join(kept)))
    return out


def test_lines_equal_brute_force(spark):
    rng = random.Random(5)
    common = [prose(rng, 4).replace("\n", " ") for _ in range(6)]
    rows = awkward(rng)
    for i in range(300):
        parts = [prose(rng, rng.randint(1, 20)) for _ in range(rng.randint(0, 4))]
        parts += [f" {rng.choice(common)}\t\r" for _ in range(rng.choice([0, 0, 1, 2]))] + ["", "  "]
        rng.shuffle(parts)
        source = rng.choice(["a", "a", "a", "b", "c", None])
        rows.append((1000 + i, "\n".join(parts), "en", source, 1))
    docs = documents(spark, rows)
    for ratio, least in ((0.05, 5), (0.2, 1), (0.0, 1)):
        out = boilerplate.without_boilerplate(docs, ratio=ratio, least_pages=least)
        assert out.columns == docs.columns
        found = Counter((r.source, r.text) for r in out.collect())
        assert found == Counter(without_lines([(r[3], r[1]) for r in rows], ratio, least))
    clash = docs.withColumn("n", F.lit(1)).withColumn("key", F.lit(1)).withColumn("a.b", F.lit(1))
    counted = boilerplate.without_boilerplate(clash, counts=("n", "gone"))
    assert counted.count() == len(rows) and counted.columns == [*clash.columns, "gone"]
    assert boilerplate.without_boilerplate(docs.limit(0)).count() == 0


def test_lines_where_columns_have_any_names(spark):
    rng = random.Random(5)
    docs = documents(spark, awkward(rng))
    names = ["__host", "__keys", "keys", "site", "row", "said", "at", "dropped", "page", "node", "keeper", "n", "pages"]
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    out = boilerplate.without_boilerplate(docs, host="source", counts=("n", "n_dropped"))
    assert out.columns == [*docs.columns, "n_dropped"]
    assert out.count() == docs.count()
    assert all(r[name] == name for r in out.collect() for name in names if name != "n")


def test_hosts_and_html(spark):
    rows = [
        ("https://u:p@WWW.Example.com:80/a?b", "<p>a<b>b</b> c</p><script>x\n</script><!-- n --><div>1 &lt; 2</div>"),
        ("no address", "plain"),
        (None, None),
    ]
    frame = spark.createDataFrame(rows, "url string, html string")
    host, lines = boilerplate.host_of(F.col("url")), boilerplate.html_lines(F.col("html"))
    found = [(r.h, r.t and [x for x in r.t.split("\n") if x]) for r in frame.select(host.alias("h"), lines.alias("t")).collect()]
    assert found == [("www.example.com", ["ab c", "1 < 2"]), (None, ["plain"]), (None, None)]


LITERALS = [
    ('BASE = "hunter2-Zq81"\npassword = BASE + "x9!k"\n', ["hunter2-Zq81", "x9!k"]),
    ("db_password: hunter2-Zq81xx\nother: 1", ["hunter2-Zq81xx"]),
    ('{"apiKey": "ab12cd34ef56gh78", "user": "bob-the-builder"}', ["ab12cd34ef56gh78"]),
    ('connect(user="a", passwd="S3cr3t!pw9", x=os.environ["TOKEN"])', ["S3cr3t!pw9"]),
    ('password: str = "qwe!23ASDzx"', ["qwe!23ASDzx"]),
    ("export AWS_SECRET_ACCESS_KEY=abcd/EFGH+1234xyz # c", ["abcd/EFGH+1234xyz"]),
    ('cfg["auth_token"] = "Zx81-Yy72-Qw63"', ["Zx81-Yy72-Qw63"]),
    ('token = prefix + "Zx81Yy72Qw63"', []),
    ('if password == "abcdefgh1234": pass', []),
    ('password = "changeme"', []),
    ('password = os.environ["PASSWORD_FILE_1"]', []),
    ("note: this is prose about a key", []),
    ("const PART='Ab3$dE6&'; const token = PART + \"gh9(jK\";", ["Ab3$dE6&", "gh9(jK"]),
    ('a = "Ab3$dE6&xx"\na = 5\nsecret = a\n', []),
    ('signing_key = b"\\x00\\x8f\\x31zz"', ["\\x00\\x8f\\x31zz"]),
    # Over several lines.
    ('password = (\n    "hunter2-"\n    "Zq81x9!k"\n)\nuser = "bob-the-builder"', ["hunter2-", "Zq81x9!k"]),
    ('password = \\\n    "hunter2-Zq81"\n', ["hunter2-Zq81"]),
    ('const token = "Zx81-Yy72"\n  + "-Qw63-Rt54";\n', ["Zx81-Yy72", "-Qw63-Rt54"]),
    ('token = "Zx81-Yy72" +\n  "-Qw63"\nother = "+"', ["Zx81-Yy72", "-Qw63"]),
    ('password = """S3cr3tV4lueXyz9"""', ["S3cr3tV4lueXyz9"]),
    ("secret = '''\nS3cr3tV4lueXyz9\n'''\n", ["\nS3cr3tV4lueXyz9\n"]),
    ("let apiKey = `ab12cd34\nef56gh78`;", []),
    ("let apiKey = `ab12cd34-ef56gh78`;", ["ab12cd34-ef56gh78"]),
    ("db:\n  password:\n    hunter2-Zq81xx\n  port: 5432\n", ["hunter2-Zq81xx"]),
    ('db:\n  password:\n    "hunter2-Zq81xx"\n', ["hunter2-Zq81xx"]),
    ("private_key: |\n  MIIEvQIBADANBgkq\n  hkiG9w0BAQEFAASC\nname: x\n", ["MIIEvQIBADANBgkq", "hkiG9w0BAQEFAASC"]),
    ('{\n  "user": "bob-the-builder",\n  "apiKey":\n    "ab12cd34ef56gh78",\n  "n": 1\n}', ["ab12cd34ef56gh78"]),
    ('connect(\n  host="example.org",\n  passwd="S3cr3t!pw9",\n)', ["S3cr3t!pw9"]),
    ('A = (\n "Ab3$dE6&"\n)\nsecret = A + "gh9(jK"\n', ["Ab3$dE6&", "gh9(jK"]),
    # A blank line ends what is open; names and prose that are none of these.
    ('note: (see\n\npassword = "hunter2-Zq81xx"\n', ["hunter2-Zq81xx"]),
    ('primary_key = "customer_id_number"', []),
    ("sort_key: created_at_descending", []),
    ('keyboard = "qwertz-uiop-1234"', []),
    ("tokens:\n  the words that a text is cut into\n", []),
    ("password:\n\n  not-its-value-1234\n", []),
    ('password = get(\n  "hunter2-Zq81xx"\n)', []),
    ('description = """a password is kept\nelsewhere"""', []),
    ("key:\n  other:\n    abcdef-123456\n", []),
]


def test_literals_that_reach_sensitive_names():
    for text, expected in LITERALS:
        spans = sorted((f[1], text[f[1] : f[2]]) for f in secret_scan.literal_spans(text))
        assert [s for _, s in spans] == expected, text


def test_precision_on_a_labelled_list():
    """Of the values in LITERALS those that are secrets are found, and no other."""
    found = missed = wrong = 0
    for text, expected in LITERALS:
        spans = [text[f[1] : f[2]] for f in secret_scan.literal_spans(text)]
        found += len([s for s in spans if s in expected])
        wrong += len([s for s in spans if s not in expected])
        missed += len([s for s in expected if s not in spans])
    assert found >= 30 and wrong == 0 and missed == 0


def test_long_open_statements_take_linear_time():
    import time

    start = time.perf_counter()
    for text in (
        "x = (" + "a = b\n" * 40_000,
        'x: """' + '"a": 1\n' * 40_000,
        "`" * 80_000 + "=",
        "key:\n" * 60_000,
        ("a = " + "'" * 3) * 20_000,
        "x = `a\n" * 20_000 + "\n\n",
        "k: |\n" + "  x: |\n" * 30_000,
    ):
        secret_scan.findings(text)
    assert time.perf_counter() - start < 30


def base(text):
    kinds = [
        ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", "AKIA[A-Z0-9]+", 0, 18),
        ("hex", "[0-9a-f]+", 0, 16),
    ]
    found = []
    for k, (kind, pattern, group, least) in enumerate(kinds):
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(6)
    bits = ["token", "PassWord", "secret", "ſecret", "toKen", "api_KEY", "apikey", "AKIA", "AKIAZZ", "=", ":", '"',
            "'", " ", "\n", "é", "🎈", "abcdef01", "0123456789abcdef", "ABCDEFGH0123", "deadbeef" * 3, "x.y-z_1", "\t"]
    rows = awkward(rng)
    rows += [(2000 + i, "".join(rng.choices(bits, k=rng.randint(1, 60))), "en", "a", 1) for i in range(1500)]
    rows += [(5000 + i, text, "en", "a", 1) for i, (text, _) in enumerate(LITERALS)]
    docs = documents(spark, rows).withColumn("r", F.lit(1))
    out = secret_scan.scanned(docs, into="r").collect()
    assert len(out) == len(rows)
    for r in out:
        text = r.text or ""
        spans = [(f.kind, f.start, f.end) for f in r.r.findings]
        assert [s for s in spans if s[0] != "literal"] == base(text), text
        assert spans == sorted(spans, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))
    assert secret_scan.scanned(docs.limit(0)).count() == 0
