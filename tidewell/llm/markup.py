r"""Markup residue in text documents.

A text is read into containers: HTML and JATS elements, entities, Markdown, wiki and LaTeX
constructs. Each container has a generalised path, its dialect and the tags with their classes
above it, with digits and repeats levelled (``html>jats:sec>jats:p``, ``html>span.hl``,
``wiki>{{}}``, ``tex>env:equation``). Containers are scored by what they hold: prose counts for a
path; link texts, keys, numbers and wording that stands alone in several texts of the host count
against it. Spark adds the votes of all texts of a host per path (the host is the delivering
source, as the records carry no site) to a small prior for the kind of element, so one path can
win at one host and lose at another. Structure that has to stay (headings, lists, tables, code,
formulas, emphasis) wins unless it has a class, what is never shown (scripts, comments) loses, and
texts are then extracted again with the host's winning paths: what stands in containers of winning
paths stays, with headings, lists, code and formulas kept in one notation; containers of losing
paths go. A construct two dialects share ("# x" is a heading or a numbered item) is read in the
dialect for which the host's votes, after the text's own, speak.

Plain signs are no markup: "<" and ">" without a known tag name, "&" without a known entity,
"$40", "a_b", "x*" and brackets.

Defined results: NULL and empty texts hold no markup; a host that is NULL votes as the host "";
an unclosed tag is a container to the end of the text.
"""

from __future__ import annotations

import html
import html.entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread

#: Losing paths of all hosts up to which the verdicts are broadcast; beyond, texts of a host are
#: spread over so many salts and joined.
MOST_PATHS, SALTS = 1_000_000, 64

#: Element names taken for markup, and those whose content is no prose.
TAGS = frozenset(
    "a abbr article aside b blockquote body br caption center cite code dd del div dl dt em fig figure font footer h1 h2 h3 h4 h5 h6 head header "
    "hr html i img inf italic bold ins kbd label li link mark math meta nav ol p pre q ref s scp sc script section sec small span strike strong "
    "style sub sup table tbody td tfoot th thead title tr tt u ul var xref".split()
)
VOID = frozenset("br hr img link meta".split())
UNSEEN = frozenset("script style head meta link".split())
STRUCTURE = frozenset(
    "h9 li ul ol dl dd dt table thead tbody tfoot tr td th caption code tt kbd pre math sub sup i b em strong italic bold sc scp br hr title u "
    "fence tick display escape wikihead strike '' item section section* subsection subsection* chapter emph textbf textit textsuperscript textsubscript".split()
)
#: Votes that a path has before any content is seen, against kinds that mostly hold references.
PRIOR = 2.0
DOUBTED = frozenset("nav ref xref template cite label footnote image".split())
#: Weights of the letters of links and of the characters of keys and numbers against those of prose.
LINKED, KEYED = 2.0, 6.0
BLOCKS = frozenset("p div sec section article blockquote ul ol table tr body header footer br title pre dl dd dt caption figure".split())

#: A necessary condition of every construct below, cheap enough for every text. Java and Python
#: read it alike.
WORTH = (
    r"</?[A-Za-z]|<!--|&(?:#|[A-Za-z])[A-Za-z0-9]{1,10};|`|\\[A-Za-z%&_#$,;{}~^!\\ ]|\$[^$\n]*[\\^_={}][^$\n]*\$|\{\{|\[\[|\]\(|''|~~"
    r"|\*[^\s*][^*\n]*\*|(?<![A-Za-z0-9])_[^\s_]|__|(?m:^[ \t]*(?:=|#{1,6}[ \t]|[*+-]{1,3}[ \t]|>[ \t]))"
)

_TOKEN = re.compile(
    r"""(?P<comment><!--.*?-->)
    |(?P<tag></?(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:\s+[\w:-]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+))*)\s*/?>)
    |(?P<entity>&(?:\#\d{1,6}|\#[xX][0-9a-fA-F]{1,5}|[A-Za-z][A-Za-z0-9]{1,10});)
    |(?P<fence>```[^\n`]*\n.*?```)
    |(?P<tick>`[^`\n]+`)
    |(?P<display>\$\$[^$]+\$\$)
    |(?P<math>\$(?=[^$\n]*[\\^_={}])[^\s$](?:[^$\n]*[^\s$])?\$)
    |(?P<begin>\\begin\{(?P<env>[A-Za-z]+\*?)\})
    |(?P<end>\\end\{[A-Za-z]+\*?\})
    |(?P<command>\\(?P<cmd>[A-Za-z]+\*?)(?:\[[^\]\n]*\])?(?P<open>\{)?)
    |(?P<escape>\\[%&_\#$,;{}~^!\\ ])
    |(?P<template>\{\{[^{}]*\}\})
    |(?P<wikilink>\[\[[^\[\]]+\]\])
    |(?P<image>!\[[^\]\n]*\]\([^)\s]+\))
    |(?P<link>\[[^\]\n]+\]\((?:https?:|/|\#|mailto:)[^)\s]*\))
    |(?P<wikihead>^[ \t]*(?P<eq>={1,6})[ \t]*[^=\n]+?[ \t]*(?P=eq)[ \t]*$)
    |(?P<hash>^[ \t]{0,3}\#{1,6}[ \t]+(?=\S))
    |(?P<bullet>^[ \t]*[*+-]{1,3}[ \t]+(?=\S))
    |(?P<quote>^>[ \t]+(?=\S))
    |(?P<quotes>'{2,5}(?=\S)[^'\n](?:[^\n]*?\S)??'{2,5})
    |(?P<strong>(?<![\w*])\*\*(?=[^\s*])[^*\n]+?(?<=[^\s*])\*\*(?![\w*])|(?<![\w_])__(?=[^\s_])[^_\n]+?(?<=[^\s_])__(?![\w_]))
    |(?P<em>(?<![\w*])\*(?=[^\s*])[^*\n]+?(?<=[^\s*])\*(?![\w*])|(?<![\w_])_(?=[^\s_])[^_\n]+?(?<=[^\s_])_(?![\w_]))
    |(?P<strike>~~(?=\S)[^~\n]+(?<=\S)~~)""",
    re.X | re.M | re.S,
)
_CLOSING = {"tex": "}"}


@dataclass
class Container:
    path: str
    start: int
    stop: int
    inner: tuple[int, int]
    sure: bool


def _known(entity: str) -> bool:
    return entity[1] == "#" or entity[1:] in html.entities.html5


def _level(text: str) -> str:
    return re.sub(r"\d+", "9", text.lower())


def dialect_signs(text: str) -> dict[str, int]:
    """How many constructs of the text belong to Markdown only, and how many to wiki only."""
    md = len(re.findall(r"```|\*\*\S|\]\(|(?<![\w_])__\S|^\#{2,6} ", text, re.M))
    wiki = len(re.findall(r"'''?|\[\[|\{\{|^=+ .*=+\s*$|<ref", text, re.M))
    return {"md": md, "wiki": wiki}


def containers(text: str, shared: str = "md") -> list[Container]:
    """All containers of a text; ``shared`` is the dialect of constructs that two dialects share."""
    out: list[Container] = []
    stack: list[tuple[str, str, int, int]] = []
    signs = dialect_signs(text)
    dialect = "wiki" if signs["wiki"] > signs["md"] else "md" if signs["md"] > signs["wiki"] else shared
    waiting: list[tuple[str, int, int]] = []

    def add(path: str, m: re.Match, cut: tuple[int, int] = (0, 0), sure: bool = True) -> None:
        out.append(Container(path, m.start(), m.end(), (m.start() + cut[0], m.end() - cut[1]), sure))

    for m in _TOKEN.finditer(text):
        kind = m.lastgroup if m.lastgroup not in ("name", "attrs", "env", "cmd", "open", "eq") else None
        kind = kind or next(k for k in ("tag", "begin", "command", "wikihead") if m.group(k))
        if kind == "tag":
            name = m["name"].lower()
            bare = name.split(":")[-1]
            if ":" not in name and bare not in TAGS or ":" in name and not name.startswith(("jats:", "mml:", "m:", "tei:")):
                continue
            css = re.search(r"""class\s*=\s*["']?([\w-]+)""", m["attrs"] or "")
            label = _level(name) + (f".{_level(css[1])}" if css else "")
            if m[0].startswith("</"):
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                if at is None:
                    out.append(Container(f"html>{label}", m.start(), m.end(), (m.end(), m.end()), True))
                else:
                    for _, path, start, inner in stack[at:]:
                        out.append(Container(path, start, m.end(), (inner, m.start()), True))
                    del stack[at:]
            else:
                path = ">".join(dict.fromkeys(["html", *(p.split(">")[-1] for _, p, _, _ in stack), label]))
                if bare in VOID or m[0].endswith("/>"):
                    out.append(Container(path, m.start(), m.end(), (m.end(), m.end()), True))
                else:
                    stack.append((name, path, m.start(), m.end()))
        elif kind == "entity":
            if _known(m[0]):
                add("entity", m)
        elif kind == "begin":
            waiting.append((m["env"], m.start(), m.end()))
        elif kind == "end":
            env = m[0][5:-1]
            at = next((w for w in reversed(waiting) if w[0] == env), None)
            start, inner = (at[1], at[2]) if at else (m.start(), m.start())
            if at:
                waiting.remove(at)
            out.append(Container(f"tex>env:{_level(env)}", start, m.end(), (inner, m.start()), True))
        elif kind == "command":
            if m["open"]:
                stop = _brace(text, m.end())
                out.append(Container(f"tex>{m['cmd'].lower()}", m.start(), stop, (m.end(), stop - 1), True))
            elif len(m["cmd"]) > 1:
                add(f"tex>{m['cmd'].lower()}", m, (m.end() - m.start(), 0))
        elif kind == "hash":
            add("md>h9" if dialect == "md" or m[0].strip() != "#" else "wiki>ol", m, (m.end() - m.start(), 0), False)
        elif kind == "bullet":
            if m[0].strip()[0] != "*" and not re.search(r"^[ \t]*[*+-]{1,3}[ \t]+\S", text[: m.start()] + text[m.end() :], re.M):
                if m.start() == 0 or not text[: m.start()].strip():
                    continue  # one dash before a line is punctuation
            add(f"{dialect}>ul", m, (m.end() - m.start(), 0), False)
        elif kind == "quotes":
            add("wiki>''", m, (2, 2))
        else:
            edge = {"fence": 3, "tick": 1, "math": 1, "display": 2, "template": 2, "wikilink": 2, "strong": 2, "em": 1, "strike": 2}.get(kind, 0)
            home = {"math": "tex", "display": "tex", "escape": "tex", "template": "wiki", "wikilink": "wiki", "wikihead": "wiki", "comment": "html"}.get(kind, "md")
            add(f"{home}>{kind}", m, (edge, edge))
    for _, path, start, inner in stack:
        out.append(Container(path, start, len(text), (inner, len(text)), True))
    for env, start, inner in waiting:
        out.append(Container(f"tex>env:{_level(env)}", start, len(text), (inner, len(text)), True))
    return sorted(out, key=lambda c: (c.start, -c.stop))


def _brace(text: str, at: int) -> int:
    depth = 1
    for i in range(at, len(text)):
        depth += (text[i] == "{") - (text[i] == "}")
        if not depth:
            return i + 1
    return len(text)


_INNER = re.compile(r"<[^<>]*>|\b(?:https?://|www\.)\S+|(?<=\])\([^()\s]*\)")
_LINKED = re.compile(r"<a\b[^<>]*>(.*?)</a>|\[\[([^\[\]]*)\]\]|\[([^\]\n]*)\]\([^)\s]*\)", re.S | re.I)


def _last(path: str) -> str:
    return path.split(">")[-1].split(".")[0].split(":")[-1]


def shown(c: Container, inside: str) -> str:
    """What of a container would be read: labels of links, unnamed parts of templates, alternative texts."""
    if c.path == "wiki>template":
        return " ".join(x for x in inside.split("|")[1:] if "=" not in x).strip()
    if c.path == "wiki>wikilink":
        return inside.split("|")[-1]
    if c.path in ("md>link", "md>image"):
        return re.match(r"!?\[([^\]]*)\]", inside)[1]
    return inside


def score(text: str, c: Container) -> tuple[float, float, str]:
    """(score, weight, wording) of a container by what it holds: letters of prose for it, those of
    links and characters of keys and numbers against it. The wording is given where it stands alone
    in its text and could be repeated in others; otherwise it is empty."""
    if fixed(c.path) is not None:
        return 0.0, 0.0, ""
    whole = text[c.inner[0] : c.inner[1]]
    inside = shown(c, whole)
    label = c.path in ("wiki>wikilink", "md>link")
    links = "" if label else " ".join(x or y or z for x, y, z in _LINKED.findall(inside))
    flat = _INNER.sub(" ", inside)
    words, keys = [], 0 if label else len(whole) - len(inside)
    for w in flat.split():
        bare = w.strip(".,;:!?()[]\"'“”‘’-–|/©")
        if bare and all(ch.isalpha() or ch in "-–'’/.,;" for ch in bare):
            words.append(bare)
        else:
            keys += len(bare)
    letters, weight = sum(map(len, words)), math.log1p(len(flat.strip()))
    if not words and re.fullmatch(r"[\s\d.,%+–-]*", flat):
        return 0.0, weight, ""  # a number alone tells nothing
    linked = min(letters, sum(ch.isalpha() for ch in links))
    value = weight * max(-1.0, (letters - linked - LINKED * linked - KEYED * keys) / max(letters + keys, 1))
    around = text[: c.start].rstrip(" ")[-1:], text[c.stop :].lstrip(" ")[:1]
    alone = not (around[0].isalnum() or around[0] in tuple(",(") or around[1].isalnum() or around[1] in tuple(",)"))
    part = alone and len(words) >= 2 and 2 * (c.stop - c.start) < len(text)
    return value, weight, _level(" ".join(flat.split())) if part else ""


def fixed(path: str) -> bool | None:
    """True for structure that has to stay, False for what is never shown, None where hosts vote."""
    last = _last(path)
    if path.startswith("html>") and last in UNSEEN or path == "html>comment":
        return False
    if path == "entity" or "." not in path.split(">")[-1] and (last in STRUCTURE or re.fullmatch(r"h\d", last)):
        return True
    return True if path in ("tex>math", "md>h9", "md>quote") or path.startswith("tex>env:") else None


def prior(path: str) -> float:
    sure = fixed(path)
    return (math.inf if sure else -math.inf) if sure is not None else -PRIOR if _last(path) in DOUBTED else PRIOR


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of a batch: added up before the shuffle, wording that may repeat text by text."""
    for batch in batches:
        sums: dict[tuple[str, str, int, int], list[float]] = {}
        for host, text in zip(batch.column("host").to_pylist(), batch.column("text").to_pylist()):
            whole = 0
            for c in containers(text):
                value, weight, wording = score(text, c)
                if wording:
                    whole = whole or xxhash.xxh3_64_intdigest(text) - (1 << 63)
                    key = (host, c.path, xxhash.xxh3_64_intdigest(wording) - (1 << 63), whole)
                else:
                    key = (host, c.path, 0, 0)
                cell = sums.setdefault(key, [0, 0.0, weight, prior(c.path)])
                cell[0] += 1
                cell[1] += value
        keys, cells = list(sums), list(sums.values())
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))),
                *(pa.array([c[i] for c in cells], t) for i, t in enumerate((pa.int64(), pa.float64(), pa.float64(), pa.float64()))),
            ],
            names=["host", "path", "wording", "whole", "n", "score", "weight", "prior"],
        )


def path_votes(texts: DataFrame) -> DataFrame:
    """(host, path, n, score, wins) over all containers of columns host and text; texts without
    markup vote on nothing.

    Wording that stands alone in several different texts of a host counts for the path once and
    against it in each further text.
    """
    votes = spread(texts.select("host", "text")).mapInArrow(_votes, "host string, path string, wording bigint, whole bigint, n bigint, score double, weight double, prior double")
    by_text = votes.groupBy("host", "path", "wording", "whole").agg(F.sum("n").alias("n"), F.sum("score").alias("score"), F.max("weight").alias("weight"), F.first("prior").alias("prior"))
    told = by_text.groupBy("host", "path", "wording").agg(
        F.sum("n").alias("n"), F.sum("score").alias("all"), F.max("score").alias("once"), F.max("weight").alias("weight"), F.count("*").alias("texts"), F.first("prior").alias("prior")
    )
    value = F.when((F.col("wording") != 0) & (F.col("texts") > 1), F.least("all", F.col("once") - (F.col("texts") - 1) * F.col("weight"))).otherwise(F.col("all"))
    total = told.groupBy("host", "path").agg(F.sum("n").alias("n"), (F.sum(value) + F.first("prior")).alias("score"))
    return total.withColumn("wins", F.col("score") > 0)


def extract(text: str, lost: frozenset[str] = frozenset(), shared: str = "md") -> tuple[str, int]:
    """(clean text, number of containers): structure is kept as Markdown headings, "- " items,
    fenced or ticked code and $formulas$."""
    found = containers(text, shared)
    if not found:
        return text, 0
    edits: list[tuple[int, int, str]] = []
    for c in found:
        raw, inside = text[c.start : c.stop], text[c.inner[0] : c.inner[1]]
        last = _last(c.path)
        if c.path in lost:
            edits.append((c.start, c.stop, ""))
            continue
        before, after = "", ""
        if c.path == "entity":
            edits.append((c.start, c.stop, html.unescape(raw)))
            continue
        if c.path.startswith("html"):
            if re.fullmatch(r"h\d", last) or c.path.endswith("jats:title"):
                before, after = "\n# ", "\n"
            elif last == "li":
                before, after = "\n- ", ""
            elif last in ("code", "tt", "kbd"):
                before = after = "`"
            elif last in BLOCKS:
                before = after = "\n"
        elif c.path.startswith("tex>env"):
            if last.rstrip("*") in ("equation", "align", "displaymath", "math", "eqnarray"):
                before = after = "$"
            else:
                before = after = "\n"
        elif last in ("section*", "section", "subsection", "subsection*", "title", "chapter"):
            before, after = "\n# ", "\n"
        elif last == "item" or c.path in ("md>ul", "wiki>ul", "wiki>ol"):
            before = "\n- " if last == "item" else "- "
        elif c.path == "md>h9":
            before = "# "
        elif c.path == "wiki>wikihead":
            edits.append((c.start, c.stop, "# " + raw.strip().strip("=").strip()))
            continue
        elif c.path in ("tex>math", "tex>display", "md>fence", "md>tick"):
            continue
        elif c.path in ("wiki>wikilink", "md>link", "md>image", "wiki>template"):
            edits.append((c.start, c.stop, shown(c, inside)))
            continue
        elif c.path == "wiki>''":
            edits.append((c.start, c.stop, raw.strip("'")))
            continue
        elif c.path == "tex>escape":
            edits.append((c.start, c.stop, {",": " ", ";": " ", "\\": "\n", "!": ""}.get(raw[1], raw[1])))
            continue
        elif c.path.startswith("tex>") and c.inner[0] == c.stop:
            continue  # a bare command such as \alpha stays as it is
        edits.append((c.start, c.inner[0], before))
        edits.append((c.inner[1], c.stop, after))
    out, at = [], 0
    for start, stop, new in sorted(edits, key=lambda e: (e[0], e[1])):
        if start < at:
            continue
        out.append(text[at:start])
        out.append(new)
        at = stop
    out.append(text[at:])
    clean = re.sub(r"[ \t]+", " ", "".join(out))
    return re.sub(r"\s*\n\s*\n\s*|[ \t]*\n[ \t]*", "\n", clean).strip(), len(found)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        clean, number = [], []
        for text, lost, shared in zip(*(batch.column(c).to_pylist() for c in ("text", "lost", "shared"))):
            got = extract(text, frozenset(lost or ()), shared or "md")
            clean.append(got[0])
            number.append(got[1])
        names = [n for n in batch.schema.names if n not in ("text", "lost", "shared", "host")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(clean, pa.string()), pa.array(number, pa.int32())], names=[*names, "clean", "containers"])


def cleaned(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, ``clean`` and ``containers`` of every text that holds markup; columns host and text."""
    # Both passes read the texts that can hold markup, which the pattern is asked once for.
    worth = cut(texts.where(F.col("text").rlike(WORTH)).select(*keys, "host", "text"))
    votes = cut(path_votes(worth))
    verdict = votes.groupBy("host").agg(
        F.collect_set(F.when(~F.col("wins"), F.col("path"))).alias("lost"),  # paths of one host
        F.sum(F.when(F.col("path").startswith("wiki>") & ~F.col("path").isin("wiki>ul", "wiki>ol"), F.col("n")).otherwise(0)).alias("wiki"),
        F.sum(F.when(F.col("path").startswith("md>") & ~F.col("path").isin("md>ul", "md>h9"), F.col("n")).otherwise(0)).alias("md"),
    )
    verdict = verdict.select("host", "lost", F.when(F.col("wiki") > 4 * F.col("md"), "wiki").otherwise("md").alias("shared"))
    types = dict(worth.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", clean string, containers int"
    if votes.count() <= MOST_PATHS:
        told = worth.join(F.broadcast(verdict), "host", "left")
    else:
        salted = verdict.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        told = worth.withColumn("_salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")).join(salted, ["host", "_salt"], "left").drop("_salt")
    return spread(told).mapInArrow(_extracted, schema).where("containers > 0")


def record_texts(screening: DataFrame, host: str = "source") -> DataFrame:
    """record_sequence, field_name, host, text of titles and abstracts."""
    fields = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in ("title", "abstract")])
    rows = screening.select(F.col("record_sequence").cast("int").alias("record_sequence"), F.coalesce(F.col(host), F.lit("")).alias("host"), F.explode(fields).alias("f"))
    return rows.select("record_sequence", "f.field_name", "host", "f.text").where("text is not null")


def marked_fields(screening: DataFrame) -> DataFrame:
    """(record_sequence, field_name) of each title or abstract that holds markup."""
    return cleaned(record_texts(screening), ["record_sequence", "field_name"]).select("record_sequence", "field_name").distinct()
