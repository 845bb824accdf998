import hashlib
import random
import zlib

import pytest

from starloom.llm import chat_format, chat_template, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, owner string, part string"


def rows_for(seed: int, n: int = 60, longest: int = 6) -> list[tuple]:
    """Conversations with shared beginnings, copies, null ids, turns, roles and texts, ties and repeated rows."""
    rnd = random.Random(seed)
    says = [(rnd.choice(["user", "assistant", None, "system"]), rnd.choice([None, "", "ja", "né", "x" * 9])) for _ in range(5)]
    rows = []
    for c in rnd.sample(range(n * 2), n):
        base = [rnd.choice(says[:2]) for _ in range(2)] + [rnd.choice(says) for _ in range(rnd.randint(0, longest))]
        for t, (role, text) in enumerate(base):
            rows.append((c, rnd.choice([None, 3]) if rnd.random() < 0.05 else t * 3, role, text, "o", "p"))
            if rnd.random() < 0.05:
                rows.append(rows[-1])
    rows += [(None, 0, "user", "stray", "o", "p")]
    rnd.shuffle(rows)
    return rows


def in_order(rows: list[tuple], tie) -> dict:
    out: dict = {}
    for c, t, role, text, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", tie(r[2] or "", r[3] or ""))):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def plain_trie(rows: list[tuple]) -> set[tuple]:
    said = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    own = {c: turns for c, turns in in_order(rows, said).items() if c is not None}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members: dict[tuple, list[int]] = {}
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members.setdefault(whole[c][:d], []).append(c)
    out = set()
    for node, ids in members.items():
        below = [v for v in members if v[: len(node)] == node]
        children = [v for v in below if len(v) == len(node) + 1]
        leaves = [v for v in below if not any(w[: len(v)] == v and len(w) == len(v) + 1 for w in below)]
        saved = sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in below if v)
        ends = ",".join(str(c) for c in ids if len(whole[c]) == len(node))
        out.add((ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_rows(df) -> list[tuple]:
    return [tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in df.collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_matches_the_plain_rule(spark, seed):
    rows = rows_for(seed)
    got = trie_rows(conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert len(got) == len(set(got))
    assert set(got) == plain_trie(rows)


def test_trie_with_small_ranges_and_long_conversations(spark, monkeypatch):
    for name, size in (("TURNS", 3), ("MEMBERS", 4), ("END_BLOCK", 3)):
        monkeypatch.setattr(conversation_trie, name, size)
    rows = rows_for(4, n=40, longest=30) + [(c, t, "user", f"t{t}", "o", "p") for c in (200, 205, 206, 207, 210) for t in range(40)] + [(c, 0, "user", "copy", "o", "p") for c in range(500, 560, 5)]
    assert set(trie_rows(conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3)))) == plain_trie(rows)


def test_trie_of_turnless_and_no_conversations(spark):
    # 1's h is 6 and it has no head, so nothing of it is left; the root alone remains
    h = zlib.crc32(b"1") % 9
    assert h > 1
    got = trie_rows(conversation_trie.prefix_trie(spark.createDataFrame([(1, 0, "user", "a", "o", "p")], SCHEMA)))
    assert got == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
    assert conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_format(rows: list[tuple]) -> dict:
    out = {}
    for c, turns in in_order(rows, lambda role, text: text).items():
        loss = "".join(text for role, text in turns if role == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


HARD = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> <s", "[", "<", "[\\/INST][/INST]", "\\", "s>", "</s", "<<s>>[[INST]]", "é</s>\U0001f600"]


def test_formatting_reads_back(spark):
    rows = rows_for(5) + [(900 + i, t, role, text, "o", "p") for i, text in enumerate(HARD) for t, role in enumerate(["user", "assistant", text, "assistant"])]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.read_back(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == plain_format(rows)
    assert chat_format.read_back(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversations_come_in_parts(spark, monkeypatch):
    rows = [(1, t, "assistant" if t % 2 else "user", f"[INST]{t}" + "é" * 3000, "o", "p") for t in range(200)] + [(2, 0, "assistant", "x" * 300_000, "o", "p")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.read_back(df).collect()}
    assert got == plain_format(rows)
    parts = sorted(chat_format.format_conversations(df).where("conv_id = 1").collect(), key=lambda r: r.part)
    assert [r.part for r in parts] == list(range(len(parts))) and len(parts) > 5
    escape = chat_template.Escape(chat_format.CONTROLS)
    loss = "".join(escape.undo(r.text[s.start : s.end]) for r in parts for s in r.spans)
    assert loss == "".join(r[3] for r in rows if r[0] == 1 and r[2] == "assistant")
    whole, _ = chat_template.render(chat_template.compile_template(chat_format.TEMPLATE, chat_format.CONTROLS), [(r[2], r[3]) for r in rows if r[0] == 1])
    assert "".join(r.text for r in parts) == whole


def test_escape_is_reversible_and_leaves_no_control():
    escape, rnd = chat_template.Escape(chat_format.CONTROLS), random.Random(3)
    seen = set()
    for _ in range(20_000):
        text = "".join(rnd.choice(["<", "[", "s>", "/s>", "/", "INST]", "/INST]", "\\", "x"]) for _ in range(rnd.randint(0, 7)))
        made = escape.apply(text)
        assert escape.undo(made) == text and not list(escape.find(made))
        seen.add((text, made))
    assert len({m for _, m in seen}) == len({t for t, _ in seen})
    with pytest.raises(chat_template.TemplateError):
        chat_template.Escape(["<a<b>"])


def test_template_language():
    t = chat_template.compile_template
    source = "{{ bos + 'x' }}{% if 1 == 2 %}no{% elif not false %}yes{% endif %}|{% for m in messages -%}  {% if loop.first %}F{% elif loop.last %}L{% else %}{{ loop.index }}{% endif %}{% generation %}{{ m['text'] | trim | upper }}{% endgeneration %}{{ ' ' + m.role | length }}{%- endfor %}{{ 'e' in 'end' }}"
    template = t(source, constants={"bos": "<b>"})
    text, spans = chat_template.render(template, [("user", " a "), ("assistant", "bc"), ("user", "d")])
    assert text == "<b>xyes|FA 42BC 9LD 4true"
    assert [text[a:b] for a, b in spans] == ["A", "BC", "D"]
    # constants are folded into single texts
    assert template.tree[0] == chat_template.Put(chat_template.Const("<b>xyes|"))
    assert template.tree[2] == chat_template.Put(chat_template.Const("true"))
    assert chat_template.render(t("plain"), [("user", "a")]) == ("plain", [])


@pytest.mark.parametrize(
    "source",
    [
        "{{ m.text }}", "{{ ''.__class__ }}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in range %}{% endfor %}", "{% if true %}x", "{{ open('x') }}", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}",
        "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}", "{{ 'x' | eval }}", "{{ 1 ", "{% import os %}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{% if true %}{% for m in messages %}{% endfor %}{% endif %}", "{{ }}", "{{ 'a' 'b' }}",
        "{% if true %}a{% else %}b{% else %}c{% endif %}", "{{ 'a' | escape }}", "{{ 'a' %}",
    ],
)
def test_templates_outside_the_language_are_refused(source):
    with pytest.raises(chat_template.TemplateError):
        chat_template.compile_template(source)
