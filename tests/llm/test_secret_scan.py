import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import rows_of

from tidecast.llm import queries
from tidecast.llm.common import table
from tidecast.llm.secret_scan import base_spans, find_spans, joined, literal_spans, name_score, redact, secret_spans, without_secrets

RULES = (
    ("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def plain_spans(text):
    """The patterns as written, failing matches dropped after the search."""
    found = [(kind, m.start(), m.end()) for kind, p, ok in RULES for m in p.finditer(text) if ok(m)]
    return sorted(found, key=lambda s: (s[1], [r[0] for r in RULES].index(s[0])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWd", "token", "api_key", "apikey", "ſecret", "toKen", ":", "=", " ", '"', "'", "AKIA", "ABCDEFGH", "0123456789abcdef", "beef", "x", "é", "\n", "longvalue"]), max_size=25).map("".join))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert base_spans(text) == plain_spans(text)


def test_short_value_hides_what_it_holds():
    assert base_spans("password: token: abcdefgh") == []
    assert base_spans("password: abcdef") == [("assign", 0, 16)]


def test_literals_by_name_and_through_constants():
    text = 'KEY = "Zx81-qLm0-77"\nclient_credential = KEY\nretry_count = "Zx81-qLm0-78"\n'
    at = text.index("Zx81")
    assert literal_spans(text) == [("literal", at, at + 12)]
    assert literal_spans('db_pwd = "Zx81qLm0" + "77aB_cd3"')[1][1] == 23
    assert literal_spans('password_hint = "Zx81qLm077"') == []
    assert literal_spans('credential = "changeme"') == []
    assert name_score("tokenCount") < 0.5 < name_score("clientSecret")


#: A text and the literals that the lexer finds in it, in order.
LITERALS = [
    ('passphrase = "correct horse battery staple"', ["correct horse battery staple"]),
    ('DB_PASS="hunter2secret9"', ["hunter2secret9"]),
    ('accesskey: "Zx81qLm077aB"', ["Zx81qLm077aB"]),
    ('authorization: "Bearer Zx81qLm077aB"', ["Zx81qLm077aB"]),
    ('Authorization: Bearer Zx81qLm077aB\n', ["Zx81qLm077aB"]),
    ('<password>hunter2secret9</password>', ["hunter2secret9"]),
    ('pwd = """Zx81qLm077aB"""', ["Zx81qLm077aB"]),
    ('{"credentials": {"value": "Zx81qLm077aB"}}', ["Zx81qLm077aB"]),
    ('creds = ["Zx81qLm077aB", "77aBZx81qLm0"]', ["Zx81qLm077aB","77aBZx81qLm0"]),
    ('pwd = f("Zx81qLm077aB")', ["Zx81qLm077aB"]),
    ('password = os.getenv("DB_PASSWORD_2")', []),
    ('pwd = config["db"]["PASSWORD_9x"]', []),
    ('os.environ["DB_PASS"] = "hunter2secret9"', ["hunter2secret9"]),
    ('os.environ.setdefault("DB_PASS", "hunter2secret9")', ["hunter2secret9"]),
    ("define('DB_PASS', 'hunter2secret9');", ["hunter2secret9"]),
    ('user.setPassword("hunter2secret9")', ["hunter2secret9"]),
    ('<add key="ApiPwd" value="hunter2secret9"/>', ["hunter2secret9"]),
    ('<user name="bob" pwd="hunter2secret9">', ["hunter2secret9"]),
    ('<credentials><value>hunter2secret9</value></credentials>', ["hunter2secret9"]),
    ('credentials:\n  value: hunter2secret9\n  user: bob.smith99\nother: hunter2secret8\n', ["hunter2secret9"]),
    ('passwords:\n  - hunter2secret9\n  - "77aBZx81qLm0"\nnames:\n  - hunter2secret8\n', ["hunter2secret9","77aBZx81qLm0"]),
    ('passwords:\n- hunter2secret9\n- abcdef12345\n', ["hunter2secret9","abcdef12345"]),
    ('[credentials]\nvalue = hunter2secret9\n[other]\nvalue = hunter2secret8\n', ["hunter2secret9"]),
    ('mysql --pwd hunter2secret9 -u bob', ["hunter2secret9"]),
    ('DBX="Zx81qLm077"\nPGPWD=$DBX\n', ["Zx81qLm077"]),
    ('DBX="Zx81qLm077"\nPGPWD="${DBX}"\n', ["Zx81qLm077"]),
    ('A_X = "Zx81qLm077"\ncreds = [A_X, "no"]', ["Zx81qLm077"]),
    ('A_X = "Zx81qLm077"\npwd = encode(A_X)', ["Zx81qLm077"]),
    ('pwd = b"Zx81qLm077"', ["Zx81qLm077"]),
    ("pwd = b'Zx81qLm077'", ["Zx81qLm077"]),
    ('"password": "Enter your password"', []),
    ('{"auth": {"username": "bob.smith99"}}', []),
    ('turnkey = "Zx81qLm077"', []),
    ('compass = "Zx81qLm077"', []),
    ('bypass: "Zx81qLm077"', []),
    ('if pwd == "Zx81qLm077": pass', []),
    ("conn = 'db_pwd=Zx81qLm077;host=x'", ["Zx81qLm077"]),
    ('he said 5" tall, db_pwd = "Zx81qLm077" ok', ["Zx81qLm077"]),
    ('The key is: the door (password) was open, said "Martha Washington".', []),
    ('pwd = (\n  "Zx81qLm0"\n  "77aB_cd3"\n)', ["Zx81qLm0","77aB_cd3"]),
    ('let pwd = `Zx81qLm077`;', ["Zx81qLm077"]),
    ('{"credentials": [{"value": "Zx81qLm077aB", "host": "db1.example.com"}], "v": "Zx81qLm077aC"}', ["Zx81qLm077aB"]),
    ('login(user="bob_smith1", pwd="Zx81qLm077")', ["Zx81qLm077"]),
    ('tokens = ["strawberry", "blueberry"]', []),
    ('creds = {\n  "db": "Zx81qLm077",\n  "ftp": "Yx81qLm077" }\nx = "Vx81qLm077"', ["Zx81qLm077","Yx81qLm077"]),
    ("pwd = '''Zx81qLm\n077aB'''", ["Zx81qLm\n077aB"]),
    ("private_key: |\n  -----BEGIN PRIVATE KEY-----\n  MIIabc\n\n  -----END PRIVATE KEY-----\nnext: 1\n", ["-----BEGIN PRIVATE KEY-----\n  MIIabc\n\n  -----END PRIVATE KEY-----"]),
]


@pytest.mark.parametrize("text, want", LITERALS, ids=range(len(LITERALS)))
def test_names_and_literals(text, want):
    assert [text[start:end] for _, start, end in literal_spans(text)] == want
    moved = "Some words, then more.\n" + text
    assert [moved[start:end] for _, start, end in literal_spans(moved)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["pwd", "credentials", "value", ":", "=", " ", '"', "'", '"""', "\n", "  ", "- ", "[", "]", "{", "}", "(", ")", "<pwd>", "</pwd>", "<", "|", "\\", ",", "+", "$", "Zx81qLm077", "é"]), max_size=40).map("".join))
def test_any_text_gives_spans_inside_it(text):
    base, every = find_spans(text)
    assert set(base) <= set(every)
    assert all(0 <= start < end <= len(text) for _, start, end in every)


@pytest.mark.parametrize("piece", ["a='", "key: [", "x=\"k='", 'pw="""', "<key>", "password", 'key="\\', "[key]\n", "key: |\n", "key: {(", "\n- key: "])
def test_long_texts_take_linear_time(piece):
    start = time.monotonic()
    find_spans("pwd: " + piece * 50_000)
    assert time.monotonic() - start < 20


def test_a_literal_inside_a_base_span_is_not_added():
    base, every = find_spans('password = "Zx81qLm077"')
    assert base == every and len(base) == 1


def test_redaction_merges_overlaps():
    assert redact("abcdefghij", [("hex", 2, 5), ("assign", 4, 7)], "#") == "ab#hij"


def test_edge_rows(make_docs):
    long = "w " * 200_000 + 'token = "abcdef0123456789abcdef012345"'
    docs = make_docs([(1, None), (2, ""), (3, long), (3, long), (None, "passwd=secret99")], clashing=True)
    empty = hashlib.sha256(b"").hexdigest()
    got = rows_of(secret_spans(docs))
    assert [r for r in got if r[0] in (1, 2)] == [(1, 0, 0, 0, empty, ""), (2, 0, 0, 0, empty, "")]
    assert [r[1:4] for r in got if r[0] == 3] == [(1, 0, 1)] * 2
    assert [r[1] for r in got if r[0] is None] == [1]
    assert secret_spans(docs.limit(0)).collect() == []


def test_cleaned_texts_keep_rows_and_columns(make_docs):
    docs = make_docs([(1, None), (2, "no secret"), (2, "no secret"), (3, "api_key: abc123def then")], clashing=True)
    out = without_secrets(docs)
    assert out.schema == docs.schema
    got = {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()}
    assert got == {(1, None, None), (2, "no secret", 9), (3, "[secret] then", 13)}
    assert out.count() == 4


def test_query_against_the_plain_patterns(spark, sf_dir):
    got = {r["doc_id"]: r for r in queries.op1_secrets(spark, sf_dir).collect()}
    docs = table(spark, sf_dir, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = plain_spans(d["text"] or "")
        r = got[d["doc_id"]]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in want) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest()
        assert set(joined(want).split(",")) <= set(r["spans"].split(","))
