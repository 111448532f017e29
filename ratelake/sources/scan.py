"""The bytes of one JSON document, inside one task: where its elements begin and end, from any place on.

A block of a document cannot tell whether it begins inside a string, nor how deep. `summarize` says what it does to
either case, `cut` yields what begins in it once its entry state is known.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np

from ratelake.sources.files import READ_BYTES

PART_BYTES = 8 << 20
FIRST_LOOK = 4096
BETWEEN = b", \t\r\n"
QUOTE, BACKSLASH, OPEN_OBJECT, CLOSE_OBJECT, OPEN_ARRAY, CLOSE_ARRAY = b'"\\{}[]'
IS_BRACKET = np.isin(np.arange(256), (OPEN_OBJECT, CLOSE_OBJECT, OPEN_ARRAY, CLOSE_ARRAY))
HEADER_SECTION = "#header"
FAILED_SECTION = "#failed"
#: Behind a section's name: text in its array that is no object or array.
BETWEEN_SECTION = "#between"
NO_SECTION = "\0"


def _real_quotes(buf: np.ndarray) -> np.ndarray:
    """Positions of the quotes that no backslash escapes."""
    quotes = np.flatnonzero(buf == QUOTE)
    doubtful = np.flatnonzero((quotes > 0) & (buf[quotes - 1] == BACKSLASH))
    if not len(doubtful):
        return quotes
    # Behind an odd run of backslashes a quote is escaped.
    slashes = np.flatnonzero(buf == BACKSLASH)
    fresh = np.diff(slashes, prepend=-2) != 1
    run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(slashes)), 0))
    last = np.searchsorted(slashes, quotes[doubtful]) - 1
    return np.delete(quotes, doubtful[(last - run_start[last]) % 2 == 0])


def _brackets(buf: np.ndarray, quotes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all brackets, and how many quotes stand before each, modulo 2."""
    at = np.flatnonzero(IS_BRACKET[buf])
    return at, np.searchsorted(quotes, at) & 1


def _steps(kinds: np.ndarray) -> np.ndarray:
    return np.where((kinds == OPEN_OBJECT) | (kinds == OPEN_ARRAY), 1, -1)


def _key_before(text: bytes, quotes: np.ndarray, end: int) -> str:
    """The key of the value that begins at `end`, "" where there is none; `quotes` are the text's real quotes."""
    behind = int(np.searchsorted(quotes, end))
    if behind < 2:
        return ""
    first, last = int(quotes[behind - 2]), int(quotes[behind - 1])
    if text[last + 1 : end].strip() != b":":
        return ""
    try:
        return json.loads(text[first : last + 1]).encode("utf-8", "replace").decode()
    except ValueError:
        return text[first + 1 : last].decode("utf-8", "replace")


def _last_token(text: bytes, in_string: bool) -> bytes | None:
    """The text from its last string on, which may still be open; None if no string begins in it."""
    quotes = _real_quotes(np.frombuffer(text, dtype=np.uint8))
    needed = 1 if in_string else 2
    return text[int(quotes[-needed]) :] if len(quotes) >= needed else None


def lead_before(look_back: Callable[[int], tuple[bytes, bool]], in_string: bool) -> bytes:
    """What a block must know of the text before it to name an array: the last key, however far back it begins."""
    length = FIRST_LOOK
    while True:
        text, whole = look_back(length)
        if not in_string and text.rstrip()[-1:] not in (b"", b'"', b":"):
            return b""
        token = _last_token(text, in_string)
        if token is not None or whole:
            return token or b""
        length *= 8


def look_back_from(stream, offset: int) -> Callable[[int], tuple[bytes, bool]]:
    """A reader of the text before an offset: the last n bytes or a few more, and whether that is all."""

    def read(length: int) -> tuple[bytes, bool]:
        start = max(0, offset - length)
        while start:
            stream.seek(start - 1)
            byte = stream.read(1)[0]
            if byte != BACKSLASH and byte < 0x80:
                break
            start -= 1
        stream.seek(start)
        return stream.read(offset - start), start == 0

    return read


def _safe_end(data: bytes) -> int:
    """Length up to which data can be cut: behind an ASCII byte that is no backslash."""
    end = len(data)
    while end and (data[end - 1] == BACKSLASH or data[end - 1] >= 0x80):
        end -= 1
    return end


def safe_offset(stream, offset: int, size: int) -> int:
    """The first place from offset on where a file can be cut."""
    if offset <= 0 or offset >= size:
        return min(max(offset, 0), size)
    stream.seek(offset - 1)
    while offset < size:
        byte = stream.read(1)[0]
        if byte != BACKSLASH and byte < 0x80:
            break
        offset += 1
    return offset


def chunks_of(stream) -> Iterator[bytes]:
    held = b""
    while data := stream.read(READ_BYTES):
        data = held + data
        end = _safe_end(data)
        held = data[end:]
        if end:
            yield data[:end]
    if held:
        yield held


def summarize(look_back: Callable[[int], tuple[bytes, bool]], data: bytes) -> dict:
    """What a block does to the state, whether it begins outside a string or inside one."""
    buf = np.frombuffer(data, dtype=np.uint8)
    quotes = _real_quotes(buf)
    brackets, odd = _brackets(buf, quotes)
    out = {"quotes": len(quotes)}
    for case, in_string in (("out", 0), ("in", 1)):
        at = brackets[odd == in_string]
        kinds = buf[at]
        step = _steps(kinds)
        before = np.cumsum(step) - step
        # Depths 1 to 3 of the document are at most 3 from here.
        seen = np.flatnonzero((step == 1) & (before <= 3))
        depths, last, counts = np.unique(before[seen][::-1], return_index=True, return_counts=True)
        opens = []
        for depth, back, count in zip(depths.tolist(), last.tolist(), counts.tolist()):
            where = int(seen[len(seen) - 1 - back])
            name = NO_SECTION if kinds[where] == OPEN_OBJECT else _name(look_back, data, quotes, int(at[where]), in_string)
            opens.append({"d": depth, "n": count, "name": name})
        out[f"delta_{case}"] = int(step.sum())
        out[f"opens_{case}"] = opens
    return out


def _name(look_back, data: bytes, quotes: np.ndarray, position: int, in_string: int) -> str:
    """The key of an array that opens in a block; only a key that begins before the block is read back."""
    behind = int(np.searchsorted(quotes, position))
    if behind >= 2:
        return _key_before(data, quotes, position)
    if data[int(quotes[0]) + 1 if behind else 0 : position].strip() not in (b"", b":"):
        return ""
    text = lead_before(look_back, bool(in_string)) + data[:position]
    return _key_before(text, _real_quotes(np.frombuffer(text, dtype=np.uint8)), len(text))


class State:
    """Where a stream stands: inside a string, how deep, in which array, at which element, in which array of it.

    `lead` is the text from the last string of depth 1 or 3 on, white space left out; it may hold an array's key.
    """

    __slots__ = ("in_string", "depth", "section", "next_item", "inner", "lead", "offset")

    def __init__(self, in_string=0, depth=0, section=NO_SECTION, next_item=0, inner=NO_SECTION, lead=b"", offset=0):
        self.in_string, self.depth, self.section, self.next_item = in_string, depth, section, next_item
        self.inner, self.lead, self.offset = inner, lead, offset


def _lead_after(lead: bytes, chunk: bytes, in_string: int) -> bytes:
    token = _last_token(lead + chunk, bool(in_string))
    if token is None or in_string:
        return token or b""
    end = int(_real_quotes(np.frombuffer(token, dtype=np.uint8))[1]) + 1
    return token[:end] + b"".join(token[end:].split())


def cut(
    chunks: Iterable[bytes], state: State, limit: float, wanted: frozenset[str], part_bytes: int = PART_BYTES, to_end: bool = False
) -> Iterator[tuple[str, int, int, bool, bytes]]:
    """(section, item_no, part, whole, text) of what begins before `limit`, from the state before the first chunk.

    Each run of text ends where the next one begins: elements, parts of them, text at depth 1 as pieces of the
    header section numbered by their offset, with null for arrays and objects, and what else stands in a wanted
    array, with the number of the next element. A part is an object of its own; its number is its offset. With
    `to_end`, a stream that ends inside a value gives a row of FAILED_SECTION.
    """
    listed = wanted - {HEADER_SECTION}
    run: tuple[str, int, int, bool] | None = None
    held: list[bytes] = []
    for chunk in chunks:
        if run is None and state.offset >= limit:
            return
        buf, base, taken, since = np.frombuffer(chunk, dtype=np.uint8), state.offset, 0, 0
        quotes = _real_quotes(buf)
        at, odd = _brackets(buf, quotes)
        at = at[odd == state.in_string]
        kinds = buf[at]
        step = _steps(kinds)
        after = state.depth + np.cumsum(step)
        low = np.minimum(after, after - step)
        edge = low <= 3
        members = at[(low == 4) & (step == 1)]

        def key(position: int) -> str:
            if np.searchsorted(quotes, position) >= 2:
                return _key_before(chunk, quotes, position)
            text = state.lead + chunk[:position]
            return _key_before(text, _real_quotes(np.frombuffer(text, dtype=np.uint8)), len(text))

        events = [*zip(at[edge].tolist(), kinds[edge].tolist(), low[edge].tolist()), (len(chunk), None, 3)]
        for position, kind, level in events:
            near = members[np.searchsorted(members, since) : np.searchsorted(members, position)]
            since = position
            while len(near) and state.section in listed and state.inner != NO_SECTION:
                # Begin with the first member here, or cut the open part before a member.
                upto = -1 if run is None else min(limit, run[2] + part_bytes) - base
                near = near[np.searchsorted(near, upto) :]
                if not len(near):
                    break
                cut, near = int(near[0]), near[1:]
                if isinstance(state.inner, int):
                    state.inner = key(state.inner) or NO_SECTION
                    if state.inner == NO_SECTION:
                        break
                if run is not None:
                    yield *run[:3], False, b"".join([*held, chunk[taken:cut]]).rstrip(BETWEEN) + b"]}"
                if base + cut >= limit:
                    return
                run, taken = (state.section, state.next_item - 1, base + cut, False), cut
                held = [b"{%s:[" % json.dumps(state.inner).encode()]
            if kind is None:
                break
            opening = kind in (OPEN_OBJECT, OPEN_ARRAY)
            if level == 3:
                # The key of an array in an element is looked up where the element is cut in it.
                state.inner = position if kind == OPEN_ARRAY else NO_SECTION
                continue
            if run is not None:
                text = b"".join([*held, chunk[taken : position + (level == 2 and not opening)]])
                if run[0] == HEADER_SECTION:
                    text += b"null" * opening
                if run[0].endswith(BETWEEN_SECTION):
                    text = text.strip(BETWEEN)
                if text:
                    yield *run, text
                run = None
            state.inner = NO_SECTION
            if level == 1:
                state.section = key(position) if kind == OPEN_ARRAY else NO_SECTION
            name, number = state.section, state.next_item
            if level == 2 and opening:
                state.next_item += 1
            if base + position >= limit:
                return
            if level == 0 and opening or level == 1 and not opening:
                name, number = HEADER_SECTION, base + position
            elif level == 1 or level == 2 and not opening:
                name += BETWEEN_SECTION
            if level + opening and name.removesuffix(BETWEEN_SECTION) in wanted:
                run, held, taken = (name, number, base + position, True), [], position + (level != 2 or not opening)
        if isinstance(state.inner, int):
            state.inner = key(state.inner) or NO_SECTION
        if run is not None:
            held.append(chunk[taken:])
        state.in_string = (state.in_string + len(quotes)) % 2
        if len(after):
            state.depth = int(after[-1])
        state.lead = _lead_after(state.lead, chunk, state.in_string) if state.depth in (1, 3) else b""
        state.offset += len(chunk)
    if run is not None and run[0] in listed:
        # The file ends inside an element: it comes out as it is and will not parse.
        yield *run, b"".join(held)
    if to_end and (state.depth or state.in_string):
        yield FAILED_SECTION, 0, 0, True, b"the document ends too early or its brackets do not match"
