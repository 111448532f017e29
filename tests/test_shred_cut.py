"""The byte-level part of the shredder against the json module, at every block size."""

import io
import json
import random

import pytest

from ratelake.sources import scan as S

TRICKY = {
    "reporting_entity_name": 'Quote " brace } [ \\ end\\',
    "in_network": [
        {"name": "a", "x": [1, {"y": "]}"}], "provider_references": [1, 2]},
        {"name": 'é\\" {"in_network": [', "n": {"m": {"k": "\\\\"}}},
        {},
    ],
    "other": {"in_network": {"z": [{}]}, "q": [[{"a": 1}]]},
    "mixed": [[{"no": 1}], {"yes": "ü"}, 3, "t{"],
    "provider_references": [{"provider_group_id": 1, "provider_groups": []}, {"provider_group_id": 2}],
    "version": "1.0",
}


def expected(doc):
    out = {}
    for section in ("in_network", "provider_references", "mixed"):
        out[section] = [item for item in doc.get(section, []) if isinstance(item, dict)]
    return out


def states(data, block, sections):
    """Entry states from the block summaries, folded in order."""
    size, state, out = len(data), (0, 0, S.NO_SECTION, 0, S.NO_SECTION), []
    stream = io.BytesIO(data)
    for number in range(max(1, -(-size // block))):
        start = S.safe_offset(stream, number * block, size)
        end = S.safe_offset(stream, (number + 1) * block, size)
        look_back = S.look_back_from(stream, start)
        in_string, depth, section, item, inner = state
        lead = S.lead_before(look_back, bool(in_string)) if depth in (1, 3) else b""
        out.append((start, end, lead, state))
        row = S.summarize(look_back, data[start:end])
        case = "in" if in_string else "out"
        opens = {o["d"]: o for o in row[f"opens_{case}"]}
        if 1 - depth in opens:
            section = opens[1 - depth]["name"]
        if 2 - depth in opens:
            item += opens[2 - depth]["n"]
        if 3 - depth in opens:
            inner = opens[3 - depth]["name"] or S.NO_SECTION
        state = ((in_string + row["quotes"]) % 2, depth + row[f"delta_{case}"], section, item, inner)
    return out


def parts(data, block, wanted, part_bytes):
    """What all blocks of a document yield, in order."""
    for start, end, lead, (in_string, depth, section, item, inner) in states(data, block, wanted):
        stream = io.BytesIO(data)
        stream.seek(start)
        state = S.State(in_string, depth, section, item, inner if depth >= 4 else S.NO_SECTION, lead, start)
        yield from S.cut(S.chunks_of(stream), state, end, wanted, part_bytes, to_end=end == len(data))


def cut(data, block, wanted, part_bytes=1 << 20):
    """The same with elements put together again from their parts."""
    open_parts = {}
    for section, number, _, whole, text in parts(data, block, wanted, part_bytes):
        if whole:
            yield section, number, text
        else:
            open_parts.setdefault((section, number), []).append(json.loads(text))
    for (section, number), found in open_parts.items():
        assert len(found) > 1
        item = {}
        for part in found:
            for key, value in part.items():
                item[key] = item.get(key, []) + value if isinstance(value, list) else value
        yield section, number, json.dumps(item).encode()


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_any_block_and_read_size(monkeypatch, indent, ascii_only):
    data = json.dumps(TRICKY, indent=indent, ensure_ascii=ascii_only).encode()
    wanted = frozenset(["in_network", "provider_references", "mixed", S.HEADER_SECTION])
    for block in [1, 2, 3, 5, 7, 11, 16, 31, 64, 200, 10_000]:
        for read in (3, 17, 1 << 20):
            monkeypatch.setattr(S, "READ_BYTES", read)
            found, header, others = {}, [], []
            for name, number, text in cut(data, block, wanted):
                if name == S.HEADER_SECTION:
                    header.append((number, text))
                elif text.startswith(b"{") and not name.endswith(S.BETWEEN_SECTION):
                    found.setdefault(name, []).append((number, json.loads(text)))
                else:
                    others.append((name, text))
            assert {name for name, _ in others} == {"mixed", "mixed" + S.BETWEEN_SECTION}
            pieces = b"".join(text for _, text in others)
            assert all(part in pieces for part in (b'[{"no": 1}]', b'3')) or indent
            assert {k: [v for _, v in sorted(rows, key=lambda r: r[0])] for k, rows in found.items()} == expected(TRICKY), (block, read)
            numbers = [n for rows in found.values() for n, _ in rows]
            assert len(set(numbers)) == len(numbers)
            text = b"{" + b"".join(t for _, t in sorted(header)) + b"}"
            scalars = {k: (v if not isinstance(v, (list, dict)) else None) for k, v in TRICKY.items()}
            assert json.loads(text) == scalars, (block, read)


def test_random_documents(monkeypatch):
    rng = random.Random(7)

    def value(depth):
        kind = rng.randrange(5 if depth else 3)
        if kind == 0:
            return "".join(rng.choice('ab"\\{}[]:,é ') for _ in range(rng.randrange(8)))
        if kind == 1:
            return rng.randrange(100)
        if kind == 2:
            return None
        if kind == 3:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        return {f"k{i}": value(depth - 1) for i in range(rng.randrange(3))}

    wanted = frozenset(["in_network", "provider_references"])
    for _ in range(60):
        doc = {"a": value(2), "in_network": [value(3) for _ in range(6)], "b": value(2),
               "provider_references": [value(2) for _ in range(4)], "c": value(1)}
        data = json.dumps(doc, ensure_ascii=rng.random() < 0.5).encode()
        block, read = rng.randrange(1, 60), rng.randrange(1, 40)
        monkeypatch.setattr(S, "READ_BYTES", read)
        found = {"in_network": [], "provider_references": []}
        for name, number, text in cut(data, block, wanted, rng.choice([1, 30, 1 << 20])):
            assert name != S.FAILED_SECTION
            if text.startswith(b"{") and not name.endswith(S.BETWEEN_SECTION):
                found[name].append((number, json.loads(text)))
        found = {name: [v for _, v in sorted(rows, key=lambda r: r[0])] for name, rows in found.items()}
        assert found == {k: [v for v in doc[k] if isinstance(v, dict)] for k in found}


@pytest.mark.parametrize("read", [5, 64, 1 << 20])
def test_nothing_is_lost_in_silence(monkeypatch, read):
    """Blanks before an array, deep nesting, members that are no objects, files cut off: at any block size."""
    monkeypatch.setattr(S, "READ_BYTES", read)
    wanted = frozenset(["in_network"])

    def rows(text, block):
        return [(name, text) for name, _, text in cut(text, block, wanted)]

    far = b'{"in_network":' + b" " * 5000 + b'[{"a":1}],"' + b"k" * 6000 + b'":[{"b":2}],"in_\\u006eetwork":[{"c":3}]}'
    deep = b'{"x":' + b"[" * 1500 + b"]" * 1500 + b',"in_network":[{"a":' + b"[" * 1300 + b"]" * 1300 + b'},{"b":2}]}'
    odd = b'{"in_network":[null, "x,", [1], {"a":1}, 7]}'
    for block in (7, 100, 1000, 4096, 1 << 20):
        assert [text for _, text in rows(far, block)] == [b'{"a":1}', b'{"c":3}'], block
        assert sorted(text[:4] for _, text in rows(deep, block)) == [b'{"a"', b'{"b"'], block
        found = [text for _, text in rows(odd, block)]
        assert b'{"a":1}' in found and b"[1]" in found
        assert b"".join(found).replace(b" ", b"").replace(b",", b"") == b'null"x"[1]{"a":1}7', block
        for end in (len(odd) - 1, len(odd) - 2, len(odd) - 9, 20, 3, 1):
            assert S.FAILED_SECTION in [name for name, _ in rows(odd[:end], block)], (block, end)


def test_parts_are_small_and_begin_in_their_block(monkeypatch):
    """One element many blocks long: no part is longer than asked for and a member, and blocks share the work."""
    monkeypatch.setattr(S, "READ_BYTES", 256)
    rates = [{"negotiated_prices": [{"negotiated_rate": i, "note": "]}" * (i % 5)}], "provider_references": [i]} for i in range(400)]
    doc = {"in_network": [{"billing_code": "1", "negotiated_rates": rates, "name": "last", "bundled_codes": [{"a": [1]}] * 9}, {"billing_code": "2"}]}
    data = json.dumps(doc).encode()
    for block, part_bytes in ((2000, 500), (1 << 20, 500), (700, 1 << 20), (100, 1)):
        wanted = frozenset(["in_network"])
        assert [json.loads(t) for _, _, t in sorted(cut(data, block, wanted, part_bytes), key=lambda r: r[1])] == doc["in_network"]
        found = [r for r in parts(data, block, wanted, part_bytes) if not r[3]]
        assert len(found) > 5 and max(len(r[4]) for r in found) <= min(part_bytes, block) + 2 * 256
        offsets = [r[2] for r in found]
        assert offsets == sorted(set(offsets))
