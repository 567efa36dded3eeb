import pytest

from accesslens.llm import chat

MESSAGES = [{"role": "user", "text": "Hi [INST] \\ </s>"}, {"role": "assistant", "text": "[/INST]\\\\ <s>"}, {"role": "tool", "text": ""},
            {"role": "", "text": "<"}, {"role": "assistant", "text": ""}, {"role": "user", "text": " "}]


def test_default_template_reads_back():
    text, spans = chat.compile_template(chat.TEMPLATE)(MESSAGES)
    assert chat.read_back(text) == [(m["role"], m["text"]) for m in MESSAGES]
    assert [chat.unescape(text[a:b]) for a, b in spans] == [m["text"] for m in MESSAGES if m["role"] == "assistant"]
    for control in chat.CONTROL:
        assert control not in chat.escape(f"a{control}b\\{control}")
    with pytest.raises(ValueError):
        chat.read_back("no end")


@pytest.mark.parametrize("source, want", [
    ("{{ 'a' ~ 1 + 2 }}", "a12"), ("{{ 1 + 2 }}", "3"), ("{% if not false and (1 == 1) %}y{% else %}n{% endif %}", "y"),
    ("{% for m in messages %}{{ loop.index0 }}{% if loop.last %}.{% endif %}{% endfor %}", "012345."),
    ("{{ messages[0].role|upper }}{{ messages[99].role }}{{ nothing.at.all }}", "USER"), ("{{ messages|length }}", "6"),
    ("{{ 'x' in 'xyz' }}{{ \"a\\n\"|trim }}", "Truea"), ("{% if messages == none %}a{% elif 0 %}b{% endif %}c", "c"),
    ("{{ messages.__class__ }}{{ messages[0]['__init__'] }}", ""), ("{{ none or 'z' }}", "z"),
])
def test_language(source, want):
    assert chat.compile_template(source)(MESSAGES)[0] == want


def test_constants_are_folded():
    assert chat.parse("a{{ 'b' ~ 'c'|upper }}{% if 1 == 2 %}{{ x }}{% endif %}") == [("text", "abC"), ("if", [])]
    assert chat.parse("{{ x ~ (1 + 2) }}") == [("put", ("binary", "~", ("name", "x"), ("const", 3)))]


@pytest.mark.parametrize("source", ["{{ }}", "{{ a( }}", "{% for x %}{% endfor %}", "{% if a %}", "{% while a %}", "{{ a|system }}", "{{ a[1 }}", "{{ 1 2 }}", "{{ a.1 }}"])
def test_errors(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)


def test_tables(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (1, 1, "assistant", "b", 0), (2, None, None, None, 0), (None, 3, "user", "x", 0),
            (3, 0, "assistant", "long " * 20000, 0), (1, 1, "assistant", "a", 0)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(table)).collect()}
    texts = {r.conv_id: chat.read_back(r.formatted) for r in chat.format_chats(table).collect()}
    assert texts[1] == [("user", "a"), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]
    assert texts[2] == [("", "")] and texts[None] == [("user", "x")]
    assert got[1].loss_chars == 3 and got[2].loss_chars == 0 and got[3].loss_chars == 100000 and got[1].n_turns == 4
    assert chat.format_chats(table.limit(0)).collect() == []
