import pytest

from vicinal.llm.secrets import base_spans, named_spans, redact, redacted, scan, spelled
from .conftest import DATA, frame, needs_data


@pytest.mark.parametrize("text, want", [
    ("password=abcdefgh", "assign:0:17"),
    ("password=abcdefg", ""),
    ("PassWord' : \"abcdefgh-1", "assign:0:23"),
    ("password: secret: abcdefghij", ""),                    # the short match is taken first, then dropped
    ("password=token=abcdefgh", "assign:0:23"),
    ("paſsword=abcdefgh Key", ""),                 # only ASCII letters match in either case
    ("é api_key:AKIAABCDEFGHIJKL", "assign:2:26,access:10:26"),
    ("AKIA123 AKIAABCDEFGHIJKL", "access:8:24"),
    ("0" * 31 + " " + "f" * 32 + "G", "hex:32:64"),
    ("", ""),
])
def test_base_patterns(text, want):
    assert spelled(base_spans(text)) == want


@pytest.mark.parametrize("text, literals", [
    ('db_password = "s3cr3t-Value9"', ["s3cr3t-Value9"]),
    ("client_secret: Zx81_kkPq0", ["Zx81_kkPq0"]),
    ('{"authToken": "a1B2c3D4e5"}', ["a1B2c3D4e5"]),
    ('x = "a1B2c3D4e5"\nother = 1\nconn.password = x', ["a1B2c3D4e5"]),          # a constant that ends up in a password
    ('p = "a1B2" + "c3D4e5"\napi_key := p', ["a1B2", "c3D4e5"]),
    ('x = "a1B2c3D4e5"\nx = "hello"\npassword = x', []),                            # overwritten before
    ('x = "a1B2c3D4e5"\nname = x', []),
    ('password = "changeme123"', []), ('token_count = "a1B2c3D4e5"', []), ('password_file = "/etc/a1B2c3"', []),
    ('title: the password is not here', []), ("see http://example.com/a=b", []), ("=" * 1000 + ":" * 1000, []),
])
def test_names_mark_literals(text, literals):
    assert [text[a:b] for a, _, b, _ in sorted(named_spans(text))] == literals


def test_redaction_takes_what_overlaps_once_and_leaves_clean_text():
    assert redacted("a token = " + "0f" * 20 + " b") == "a token = [SECRET] b"
    assert redacted("nothing: here = 1") == "nothing: here = 1"
    again = redacted("password='abcdefghij' AKIAABCDEFGHIJKL")
    assert again == "password='[SECRET]' [SECRET]" and redacted(again) == again


def test_tables(spark):
    rows = [(1, None, 5, "x"), (2, "", 0, None), (3, "password=abcdefgh", 17, "y"), (3, "password=abcdefgh", 17, "y"), (None, "é " * 50_000 + "token=12345678", 9, "z")]
    docs = frame(spark, rows, "doc_id long, text string, n_chars long, spans string")
    got = sorted(map(tuple, scan(docs).collect()), key=str)
    assert [(r[0], r[1], r[5]) for r in got] == [(1, 0, ""), (2, 0, ""), (3, 1, "assign:0:17"), (3, 1, "assign:0:17"), (None, 1, "assign:100000:100014")]
    clean = redact(docs)
    assert clean.schema == docs.schema
    new = {r.doc_id: r for r in clean.collect()}
    assert new[1] == rows[0] and new[2] == rows[1] and new[3].text == "password=[SECRET]" and new[3].n_chars == 17
    assert new[None].n_chars == 100_014 and redact(frame(spark, [])).collect() == []


@pytest.mark.parametrize("text, parts", [
    ("password = " + " + ".join(f'"p{n}Q"' for n in range(200)), 200),
    ('k = "a1B2"\n' + "".join(f'k = k + "c{n}D"\n' for n in range(500)) + "api_key = k", 501),
    ('k = "a1B2c3D4"\n' + "k = k + k\n" * 3000 + "password = k", 1),                      # 2 ** 3003 characters
    ('password = "a1B2" +\n    "c3D4"\n  + "e5F6" \\\n + "g7H8"', 4),
    ('password = "a1B2c3D4e5"\n+other = 1\n+api_key = "f6G7h8I9j0"\n+"secret": "k1L2m3N4"', 3),     # a diff adds lines, not parts
    ('password = "cha" + "ngeme12"', 0), ('password = "undef" + "ined"', 0), ('password = "a1B2" + "c3 D4"', 0),
])
def test_every_part_of_a_literal_is_found(text, parts):
    got = [text[a:b] for a, _, b, _ in sorted(named_spans(text))]
    assert len(got) == parts
    if parts:
        assert not any(p in redacted(text) for p in got)


@needs_data
def test_base_spans_of_all_documents_equal_a_plain_scan(spark):
    """The query over its whole table against the contract's patterns, read by a scanner of its own without any shortcut."""
    import hashlib

    from vicinal.llm import queries

    def runs(text, allowed, at):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    digits, capitals, small = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    value = set(capitals + small + digits + "+/_.=-")

    def assigned(text, at):
        """(end, length of group 2) of an assignment that begins here."""
        low = "".join(chr(ord(c) + 32) if c in capitals else c for c in text[at:at + 8])
        name = next((n for n in ("password", "passwd", "secret", "token", "apikey", "api_key") if low.startswith(n)), None)
        if name is None:
            return None
        p = at + len(name)
        p += p < len(text) and text[p] in "\"'"
        p = runs(text, " ", p)
        if p >= len(text) or text[p] not in ":=":
            return None
        p = runs(text, " ", p + 1)
        p += p < len(text) and text[p] in "\"'"
        end = runs(text, value, p)
        return (end, end - p) if end > p else None

    def spans(text):
        out = []
        at = 0
        while at < len(text):
            hit = assigned(text, at)
            if hit and hit[1] >= 8:
                out.append((at, 0, "assign", hit[0]))
            at = hit[0] if hit else at + 1
        at = 0
        while (at := text.find("AKIA", at)) >= 0:
            end = runs(text, capitals + digits, at + 4)
            if end > at + 4 and end - at >= 16:
                out.append((at, 1, "access", end))
            at = end if end > at + 4 else at + 1
        at = 0
        while at < len(text):
            end = runs(text, "0123456789abcdef", at)
            if end - at >= 32:
                out.append((at, 2, "hex", end))
            at = max(end, at + 1)
        return sorted(out)

    data = DATA.replace("sf0.001", "sf0.01")      # the smallest scale has no secret
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = queries.op4_secret_scan(spark, data).collect()
    assert len(got) == len(docs) and sum(r.n_assign + r.n_access + r.n_hex for r in got) > 5
    for r in got:
        want = spans(docs[r.doc_id])
        said = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w[1] == k for w in want) for k in range(3)]
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))
