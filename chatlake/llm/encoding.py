r"""Texts decoded with the wrong character encoding, found and restored.

Method. Every distinct word of the corpus with a character beyond ASCII is garbled under all encoding chains: encoded as
a text of that language would be, decoded by a wrong single-byte or double-byte table, once or twice. The garbled forms
are joined by hash with the distinct words of the documents. A match through UTF-8 and a table of single bytes, or with
lost bytes, cannot be a word of a language, so there any word is an original, even one of a single document. A match of
a chain that may map letters to letters counts where the original stands in MIN_DOCS documents and is clearly more
frequent than the form, so that two such encodings do not accuse each other. The original replaces the form. A word is a
run of ASCII letters and digits and characters beyond ASCII; runs of digits are one sign, since they survive any of the
chains. Numeric entities (&#195;) are read as their characters first, since garbled text is often written so.

Scripts without spaces have no words that recur; there the words are pairs of neighbouring characters, and their garbled
forms, of any length, are looked up at every position of every word, and compared whole. A word is odd with a character
of another script than those, or, where it has none, when a double-byte table turns it back into UTF-8 or into Japanese
or Korean. Any other word may be clean (what Chinese read by another Chinese table gives is Chinese again), so there a
form counts only where its original stands in clearly more texts than the form does, and, but for chains through UTF-8,
beside another form of the same chain in the word.

A document is garbled when its matches weigh 1 or more: a match of a chain through UTF-8 or of four or more characters
weighs 1, a shorter one less. Restoring: matched words are replaced. In a stretch found by character pairs, and for words
without a known original in a document garbled through UTF-8, the chain is run backwards, and the result kept if garbling
it again gives the stretch.

Null, empty and pure ASCII texts without such entities are never garbled. Repeated rows count once per doc_id. Empty tables give empty results.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.runtime import cut

#: Wrong tables that UTF-8 is read with, and (true, wrong) pairs of other encodings. Names are those of the codecs.
WRONG = ["latin-1", "cp1252", "mac_roman", "cp437", "cp850", "cp1251", "cp866", "koi8_r", "cp1250", "iso8859_2", "cp1253", "cp1254", "iso8859_15", "cp1257", "cp1258", "cp1255", "cp1256", "cp932", "gbk", "big5", "euc_kr"]
PAIRS = [
    *((t, w) for t in ("cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic") for w in ("latin-1", "cp1252", "cp437", "cp850", "mac_roman", "cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic") if t != w),
    *((t, w) for t in ("cp1253", "iso8859_7", "cp1250", "iso8859_2", "cp1254", "cp1255", "cp1256") for w in ("latin-1", "cp1252", "cp437", "cp850", "mac_roman", "cp1251")),
    *((t, w) for t in ("cp1252", "mac_roman", "cp437", "cp850") for w in ("latin-1", "cp1252", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "cp866", "koi8_r", "iso8859_5") if t != w),
    *((t, w) for t in ("shift_jis", "euc_jp", "gbk", "big5", "euc_kr") for w in ("latin-1", "cp1252", "mac_roman", "cp437", "cp1251", "koi8_r")),
    *((t, w) for t, w in (("shift_jis", "gbk"), ("gbk", "big5"), ("gbk", "shift_jis"), ("euc_jp", "shift_jis"), ("shift_jis", "euc_jp"), ("euc_jp", "gbk"), ("big5", "gbk"), ("euc_kr", "gbk"))),
    *((t, "utf-8") for t in ("cp1252", "cp1251", "koi8_r", "cp1253", "iso8859_2", "cp1250", "cp1254", "shift_jis", "gbk", "euc_jp")),
]
#: Chains of two steps, both through UTF-8: all pairs of these tables.
_TWICE = ["latin-1", "cp1252", "mac_roman", "cp437", "cp850", "cp1251"]
TWICE = [(a, b) for a in _TWICE for b in _TWICE]
CHAINS: list[tuple[tuple[str, str], ...]] = [(("utf-8", w),) for w in WRONG] + [(p,) for p in PAIRS] + [(("utf-8", a), ("utf-8", b)) for a, b in TWICE]

#: Where letters may turn into letters, a word stands as an original when it occurs in so many documents, and in so many
#: times as many distinct texts as its garbled form (or in as many, and in so many times as many documents).
MIN_DOCS, TIMES = 2, 2.0
WORD = r"[0-9A-Za-z]*[^\x00-\x7f](?:[0-9A-Za-z]|[^\x00-\x7f])*"
_SPACELESS = "぀-ヿ㐀-鿿　-〿＀-･가-힯฀-๿"
_KNOWN = re.compile(f"[\x00-\x7f{_SPACELESS}Ѐ-ӿͰ-Ͽ֐-ۿ]+")
_PAIR = re.compile(f"[{_SPACELESS}]{{2,}}")
_ANY = re.compile(f"[{_SPACELESS}]")
_KANA, _HANGUL = re.compile("[぀-ヿ]"), re.compile("[가-힯]")
#: Lengths of the beginnings by which forms of character pairs are looked up, with what must follow in a longer form.
KEYS = {2: 0, 3: 0, 4: 0, 5: 0, 6: 5, 12: 24}
#: Rows of a batch of windows or forms.
_ROWS = 50_000

_tables: dict[str, str] = {}
_backs: dict[str, dict[str, int]] = {}


def _wrong_table(name: str) -> str:
    """Character of each byte; bytes that the table lacks become the control character of that number."""
    if name not in _tables:
        out = []
        for i in range(256):
            try:
                out.append(bytes([i]).decode(name))
            except UnicodeDecodeError:
                out.append(chr(i))
        _tables[name] = "".join(out)
    return _tables[name]


def _back_table(name: str) -> dict[str, int]:
    if name not in _backs:
        _backs[name] = {c: i for i, c in reversed(list(enumerate(_wrong_table(name))))}
    return _backs[name]


_WIDE = {"cp932", "gbk", "big5", "euc_kr", "shift_jis", "euc_jp"}


def _read(raw: bytes, wrong: str) -> str | None:
    try:
        if wrong == "utf-8":  # what is no UTF-8 is lost
            text = raw.decode(wrong, "replace")
            return text if "\ufffd" in text else None
        return raw.decode(wrong) if wrong in _WIDE else codecs.charmap_decode(raw, "strict", _wrong_table(wrong))[0]
    except UnicodeDecodeError:
        return None


def garble(word: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The word after a chain of wrong decodings, or None where the chain cannot carry it."""
    for true, wrong in chain:
        try:
            raw = word.encode(true)
        except UnicodeEncodeError:
            return None
        read = _read(raw, wrong)
        if read is None:
            return None
        word = read
    return word


def garble_all(word: str) -> dict[str, list[int]]:
    """Each form of a word that is not ASCII and not the word, with the numbers of the chains that give it."""
    raws: dict[str, bytes | None] = {}
    firsts: dict[tuple[str, str], str | None] = {}
    out: dict[str, list[int]] = {}
    for n, chain in enumerate(CHAINS):
        step = chain[0]
        if step not in firsts:
            true, wrong = step
            if true not in raws:
                try:
                    raws[true] = word.encode(true)
                except UnicodeEncodeError:
                    raws[true] = None
            firsts[step] = None if raws[true] is None else _read(raws[true], wrong)
        form = firsts[step]
        if form is not None and len(chain) > 1:
            form = garble(form, chain[1:])
        if form and form != word and not form.isascii():
            out.setdefault(form, []).append(n)
    return out


def ungarble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The inverse of `garble`."""
    for true, wrong in reversed(chain):
        try:
            if wrong in _WIDE:
                raw = text.encode(wrong)
            else:
                back = _back_table(wrong)
                raw = bytes(back[c] for c in text)
            text = raw.decode(true)
        except (UnicodeEncodeError, UnicodeDecodeError, KeyError):
            return None
    return text


def _name(chain: tuple[tuple[str, str], ...]) -> str:
    return "+".join(f"{t}>{w}" for t, w in chain)


_NAMES = [_name(c) for c in CHAINS]
_BY_NAME = dict(zip(_NAMES, CHAINS, strict=True))


def _plain(chain: tuple[tuple[str, str], ...]) -> bool:
    """Whether what the chain makes cannot be taken for words of a language."""
    return chain[0][1] == "utf-8" or all(t == "utf-8" and w not in _WIDE for t, w in chain)


_PLAIN = {n for n, c in enumerate(CHAINS) if _plain(c)}
#: Chains from one double-byte table to another, whose forms are of the same scripts.
_ALIKE = {n for n, c in enumerate(CHAINS) if c[0][0] in _WIDE and c[0][1] in _WIDE}
_UTF = [n for n, c in enumerate(CHAINS) if c[0][0] == "utf-8"]
_BACK_UTF8 = [c for c in CHAINS if len(c) == 1 and c[0][0] == "utf-8" and c[0][1] in _WIDE]
_BACK_SOUND = [c for n, c in enumerate(CHAINS) if n in _ALIKE and c[0][0] in ("shift_jis", "euc_jp", "euc_kr")]


def _foreign(word: str) -> int:
    return sum(c > "\x7f" for c in word)


def _key(form: str) -> tuple[str, str] | None:
    """(beginning, rest) by which a form of a character pair is looked up."""
    size = max((k for k in KEYS if k <= len(form)), default=0)
    return (form[:size], form[size:]) if size else None


#: `chains` are numbers of chains, joined by commas: there are very many forms, and few of them occur. `wid` is null for pairs.
_FORM = "key string, tail string, wid bigint, word string, docs bigint, texts bigint, chains string, weight double, plain boolean, pair boolean"


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The forms of each word (wid, word, docs, texts, pair); one row for all plain chains of a form, one for all others."""
    columns = [x.split()[0] for x in _FORM.split(", ")]
    out: list[tuple] = []
    for b in batches:
        for i, w, docs, texts, pair in zip(b["wid"].astype("Int64"), b["word"], b["docs"], b["texts"], b["pair"], strict=True):
            letters = len(w) > 2 and any(c > "\x7f" and c.isalpha() for c in w)
            for f, numbers in garble_all(w).items():
                n = _foreign(f)
                for plain in (True, False):
                    chains = [c for c in numbers if (c in _PLAIN) == plain]
                    if not pair and not plain:
                        chains = [c for c in chains if CHAINS[c][0][0] == "utf-8" or letters] if docs >= MIN_DOCS else []
                    if not chains:
                        continue
                    if pair:
                        at = _key(f)
                        alike = [c for c in chains if c in _ALIKE]
                        for some, weight in ((alike, 0.2), ([c for c in chains if c not in _ALIKE], 0.5)):
                            if at and some:
                                out.append((*at, None, w, docs, texts, ",".join(map(str, some)), weight, plain, True))
                    else:
                        utf = any(CHAINS[c][0][0] == "utf-8" for c in chains)
                        weight = 1.0 if utf and n > 1 or n >= 4 or any(CHAINS[c][0][1] == "utf-8" for c in chains) else 0.5 if len(f) >= 4 else 0.2
                        out.append((f, "", i, None, docs, texts, ",".join(map(str, chains)), weight, plain, False))
            if len(out) >= _ROWS:
                yield pd.DataFrame(out, columns=columns).astype({"wid": "Int64"})
                out = []
    if out:
        yield pd.DataFrame(out, columns=columns).astype({"wid": "Int64"})


def _pairs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, docs, texts): the character pairs of words in scripts without spaces."""
    for b in batches:
        out: dict[str, list[int]] = {}
        for w, docs, texts in zip(b["word"], b["docs"], b["texts"], strict=True):
            for run in _PAIR.findall(w):
                for i in range(len(run) - 1):
                    n = out.setdefault(run[i : i + 2], [0, 0])
                    n[0] += docs
                    n[1] += texts
        if out:
            yield pd.DataFrame({"word": list(out), "docs": [n for n, _ in out.values()], "texts": [n for _, n in out.values()]})


def odd(word: str) -> bool:
    """Whether a word cannot be clean, so that forms in it count however often they stand elsewhere."""
    if _foreign(word) < 4:
        return False
    if _KNOWN.sub("", word):
        return True
    if not _PAIR.search(word):
        return False
    for ((true, wrong),) in _BACK_UTF8:
        raw = word.encode(wrong, "ignore")
        if 6 * sum(c > "\u07ff" for c in raw.decode(true, "ignore")) >= len(raw) > 0:  # half of it, in characters of three bytes
            return True
    for ((true, wrong),) in _BACK_SOUND:
        sound, share = (_HANGUL, 0.95) if true == "euc_kr" else (_KANA, 0.33)  # Chinese read backwards is half Hangul
        back = "" if _KANA.search(word) or _HANGUL.search(word) else word.encode(wrong, "ignore").decode(true, "ignore")
        if len(sound.findall(back)) >= share * len(back) > 0:
            return True
    return False


def _pieces(word: str) -> set[tuple[str, str]]:
    """(key, tail): the pieces of a word that may be garbled character pairs. Only chains of two steps, which give no
    character of scripts without spaces, make a form of more than six."""
    out = set()
    for size, more in KEYS.items():
        for j in range(len(word) - size + 1):
            k = word[j : j + size]
            if k[0] > "\x7f" or k[-1] > "\x7f":
                if not more:
                    out.add((k, ""))
                elif not _ANY.search(k):
                    out.add((k, word[j + size : j + size + more]))
                elif size == 6:
                    out.add((k, ""))
    return out


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, tail, at, at_texts, odd): the pieces of all words; `at` is the word's number."""
    columns, out = ["key", "tail", "at", "at_texts", "odd"], []
    for b in batches:
        for i, w, texts in zip(b["wid"], b["word"], b["texts"], strict=True):
            sure = odd(w)
            out += [(k, t, i, texts, sure) for k, t in _pieces(w)]
            if len(out) >= _ROWS:
                yield pd.DataFrame(out, columns=columns)
                out = []
    if out:
        yield pd.DataFrame(out, columns=columns)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, seen): in how many texts the keys of `_windows` stand, in parts."""
    seen: dict[str, int] = {}
    for b in batches:
        for w, texts in zip(b["word"], b["texts"], strict=True):
            for k in {k for k, _ in _pieces(w)}:
                seen[k] = seen.get(k, 0) + texts
            if len(seen) >= _ROWS:
                yield pd.DataFrame({"key": list(seen), "seen": list(seen.values())})
                seen = {}
    if seen:
        yield pd.DataFrame({"key": list(seen), "seen": list(seen.values())})


def _confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows (form, word, number, ...) whose word gives the form by the chain of that number."""
    for b in batches:
        yield b[[garble(w, CHAINS[n]) == f for f, w, n in zip(b["form"], b["word"], b["number"], strict=True)]]


def _digits(col: str) -> object:
    return F.regexp_replace(col, "[0-9]+", "0")


def _chain_name(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, _NAMES)), number.cast("int") + 1)


_ENTITY = r"&#(?:[0-9]{2,7}|[xX][0-9A-Fa-f]{2,6});"


def read_entities(text: Column) -> Column:
    """The text with its numeric entities beyond ASCII read as characters; others stay."""
    piece = lambda x: F.when(x.rlike("^&#[xX]"), F.lower(F.regexp_extract(x, "^&#[xX]([0-9A-Fa-f]+);", 1))).when(x.rlike("^&#[0-9]+;"), F.lower(F.hex(F.regexp_extract(x, "^&#([0-9]+);", 1).cast("bigint"))))
    number = lambda x: F.conv(piece(x), 16, 10).cast("bigint")
    known = lambda x: number(x).between(128, 0xD7FF) | number(x).between(0xE000, 0x10FFFF)
    read = F.transform(F.regexp_extract_all(text, F.lit(f"{_ENTITY}|&|[^&]+"), F.lit(0)), lambda x: F.when(known(x), F.decode(F.unhex(F.lpad(piece(x), 8, "0")), "UTF-32")).otherwise(x))
    return F.when(text.rlike(_ENTITY), F.array_join(read, "")).otherwise(text)


def _tasks(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)


def find_garbled(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(found, matches).

    found: (id, weight, chain), a row per garbled document with its heaviest chain. matches: (form, at, word, chain,
    weight, pair), the forms that occur, with the word they stand in and their originals; of several originals the most
    frequent.

    Both sides of the joins with the forms grow with the corpus's words, so nothing there is broadcast by hint. Forms of
    words travel as hashes with the number of their word, and those that meet a word of the documents are made again from
    their word and compared. Windows are counted by key, the counts leave the forms of pairs that stand somewhere, and
    only these, mostly few, meet the windows; these carry the number of their word and not the word. The words of a document are made distinct before they are shuffled,
    and counts combine before the shuffle. Python stages are spread over a stated number of tasks. The matches are as
    many as there are distinct garbled words, not documents.
    """
    some = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).rlike(rf"[^\x00-\x7f]|{_ENTITY}")).select(F.col(id_col).alias("id"), read_entities(F.col(text_col)).alias("text"))
    base = some.select("id", F.xxhash64("text").alias("hash"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), 0))).alias("raw"))
    said = cut(base.select("id", "hash", _digits("raw").alias("word")), "words")
    per_text = said.groupBy("id", "word").agg(F.min("hash").alias("hash")).groupBy("word", "hash").agg(F.count("*").alias("docs"))
    vocab = per_text.groupBy("word").agg(F.sum("docs").alias("docs"), F.count("*").alias("texts"))
    vocab = cut(vocab.withColumn("wid", F.monotonically_increasing_id()), "vocab")
    tasks = _tasks(docs)
    spread = vocab.repartition(tasks, "word")
    pairs = spread.mapInPandas(_pairs_of, "word string, docs bigint, texts bigint").groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts")).filter(f"docs >= {MIN_DOCS}")
    words = vocab.select("wid", "word", "docs", "texts", F.lit(False).alias("pair")).unionByName(pairs.select(F.lit(None).cast("bigint").alias("wid"), "*", F.lit(True).alias("pair")))
    forms = words.repartition(tasks, "word").mapInPandas(_forms, _FORM)
    forms = cut(forms.withColumns({"hash": F.when(~F.col("pair"), F.xxhash64("key")), "key": F.when(F.col("pair"), F.col("key"))}), "forms")

    seen = vocab.select(F.xxhash64("word").alias("hash"), F.col("word").alias("form"), F.col("docs").alias("seen"), F.col("texts").alias("seen_texts"))
    more = (F.col("texts") >= F.col("seen_texts") * TIMES) | (F.col("texts") >= F.col("seen_texts")) & (F.col("docs") >= F.col("seen") * TIMES)
    best = F.max(F.struct("docs", "word", "weight"))
    numbers = F.explode(F.split("chains", ",").cast("array<int>")).alias("number")
    met = seen.join(forms.filter("not pair").select("hash", "wid", "docs", "texts", "chains", "weight", "plain").hint("merge"), "hash").filter(F.col("plain") | more)
    met = cut(met.select("form", "wid", "docs", "weight", numbers), "met").join(vocab.select("wid", "word"), "wid")
    whole = met.select("form", "word", "number", "docs", "weight").mapInPandas(_confirmed, "form string, word string, number int, docs bigint, weight double")
    whole = whole.groupBy("form", "number").agg(best.alias("b"))
    whole = whole.select("form", F.col("form").alias("at"), "b.word", _chain_name(F.col("number")).alias("chain"), "b.weight", F.lit(False).alias("pair"))

    counts = spread.mapInPandas(_counts, "key string, seen bigint").groupBy("key").agg(F.sum("seen").alias("seen"))
    live = forms.filter("pair").select("key", F.col("tail").alias("rest"), "word", "docs", "texts", "chains", "weight").hint("merge").join(counts, "key")
    live = cut(live.withColumn("rarer", F.col("texts") >= F.col("seen") * TIMES).drop("seen"), "live")
    windows = spread.mapInPandas(_windows, "key string, tail string, at bigint, at_texts bigint, odd boolean")
    alike = F.col("weight") < 0.5
    inner = windows.join(live, "key").filter(F.startswith("tail", F.col("rest")) & F.when(F.col("odd"), ~alike | (F.col("texts") >= F.col("at_texts") * TIMES)).otherwise(F.col("rarer")))
    utf = F.col("number").isin(_UTF)
    inner = inner.select(F.concat("key", "rest").alias("form"), "at", "odd", "docs", "word", "weight", numbers).withColumn("weight", F.when(F.col("odd") | utf, F.col("weight")).otherwise(0.2))
    inner = inner.groupBy("form", "at", "odd", "number").agg(best.alias("b")).groupBy("at", "odd", "number").agg(F.collect_list(F.struct("form", "b")).alias("l"))
    inner = inner.filter(F.col("odd") | utf | (F.size("l") > 1)).select("at", "number", F.explode("l").alias("x"))
    inner = inner.join(vocab.select(F.col("wid").alias("at"), F.col("word").alias("in_word")).hint("merge"), "at")
    inner = inner.select("x.form", F.col("in_word").alias("at"), "x.b.word", _chain_name(F.col("number")).alias("chain"), "x.b.weight", F.lit(True).alias("pair"))
    matches = cut(whole.unionByName(inner), "matches")
    scores = matches.groupBy("at", "chain").agg(F.max(F.when(~F.col("pair"), F.col("weight"))).alias("w"), F.least(F.sum(F.when(F.col("pair"), F.col("weight"))), F.lit(1.0)).alias("p"))
    scores = cut(scores.select(F.col("at").alias("word"), "chain", F.greatest(F.coalesce("w", F.lit(0.0)), F.coalesce("p", F.lit(0.0))).alias("weight")), "scores")
    # both sides are written tables, so adaptive execution splits a garbled word that stands in very many documents
    per_doc = said.select("id", "word").join(scores.hint("merge"), "word").groupBy("id", "chain").agg(F.sum("weight").alias("weight"))
    found = per_doc.groupBy("id").agg(F.max(F.struct("weight", "chain")).alias("b")).select("id", "b.weight", "b.chain").filter("weight >= 1")
    return found, matches


_WORD = re.compile(WORD)
_DIGITS = re.compile("[0-9]+")


def _put_digits(word: str, raw: str) -> str:
    digits = iter(_DIGITS.findall(raw))
    return _DIGITS.sub(lambda m: next(digits, m.group()), word)


def _undo(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text before a chain, if garbling that gives the text again."""
    back = ungarble(text, chain)
    return back if back is not None and back != text and garble(back, chain) == text else None


def _stretches(word: str, forms: list[str]) -> list[tuple[int, int]]:
    """Where the forms stand in a word; a gap that one unknown character may have left is closed."""
    out: list[tuple[int, int]] = []
    for a, b in sorted({(m.start(), m.start() + len(f)) for f in forms for m in re.finditer(f"(?={re.escape(f)})", word)}):
        if out and a <= out[-1][1] + 3:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def restore_text(text: str, whole: dict[str, str], inner: dict[str, list[tuple[str, list[str]]]], chain: str | None = None) -> tuple[str, int]:
    """(text with the originals, words replaced). `whole` maps a garbled word to its original, `inner` a word with
    garbled stretches to the names of the chains that may have made them, each with the forms that stand there; both with
    digits as one sign. `chain`, where it is plain, is undone in all words that it can have made."""
    n = 0
    own = _BY_NAME[chain] if chain in _BY_NAME and _plain(_BY_NAME[chain]) and all(t == "utf-8" for t, _ in _BY_NAME[chain]) else None

    def one(m: re.Match) -> str:
        nonlocal n
        raw = m.group()
        key = _DIGITS.sub("0", raw)
        if key in whole:
            n += 1
            return _put_digits(whole[key], raw)
        if key in inner:
            chains = [_BY_NAME[c] for c, _ in inner[key]]
            runs = [r.span() for r in re.finditer(f"[^{_SPACELESS}]+", raw)] or [(0, len(raw))] * odd(key)  # clean neighbours stay
            for spans, some in ((runs, chains), *((_stretches(raw, f), [_BY_NAME[c]]) for c, f in inner[key])):
                out, at = [], 0
                for a, b in spans:
                    good = next((g for c in some if (g := _undo(raw[a:b], c)) is not None and _PAIR.search(g)), None)
                    if good is not None:
                        out += [raw[at:a], good]
                        at, n = b, n + 1
                if out:
                    return "".join(out) + raw[at:]
            return raw
        if own and (good := _undo(raw, own)) is not None:
            n += 1
            return good
        return raw

    return _WORD.sub(one, text), n


def restore_garbled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, n_replaced, chain): the garbled documents with their originals put back where these are known.

    Words whose original is itself a garbled form are followed to the end. A document's own matches travel with it; no
    table of all matches is sent to every task.
    """
    found, matches = find_garbled(docs, id_col, text_col)
    whole = matches.filter("not pair").groupBy("form").agg(F.max_by("word", "weight").alias("word"))
    for _ in range(2):  # as many steps as chains have
        nxt = whole.select(F.col("form").alias("word"), F.col("word").alias("word2"))
        whole = whole.join(nxt, "word", "left").select("form", F.coalesce("word2", "word").alias("word"))
    inner = matches.filter("pair").groupBy("at", "chain").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("form")).alias("forms"))
    inner = inner.groupBy("at").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "chain", "forms"))), lambda x: F.struct(x["chain"].alias("chain"), x["forms"].alias("forms"))).alias("by"))
    fix = cut(whole.select(F.col("form").alias("key"), "word", F.lit(None).cast("array<struct<chain:string,forms:array<string>>>").alias("by")).unionByName(inner.select(F.col("at").alias("key"), F.lit(None).cast("string").alias("word"), "by")), "fixes")
    texts = docs.select(F.col(id_col).alias("id"), read_entities(F.col(text_col)).alias("text")).join(found.select("id", "chain"), "id").dropDuplicates(["id"])
    texts = cut(texts, "garbled")
    words = texts.select("id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), 0))).alias("raw")).select("id", _digits("raw").alias("key")).distinct()
    own = words.join(fix, "key").groupBy("id").agg(F.collect_list(F.struct("key", "word", "by")).alias("fixes"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t, chain, fixes in zip(b["id"], b["text"], b["chain"], b["fixes"], strict=True):
                fixes = [] if fixes is None else fixes
                new, n = restore_text(t, {x["key"]: x["word"] for x in fixes if x["word"] is not None}, {x["key"]: [(y["chain"], list(y["forms"])) for y in x["by"]] for x in fixes if x["word"] is None}, chain)
                out.append((i, new, n, chain))
            yield pd.DataFrame(out, columns=["id", "text", "n_replaced", "chain"])

    joined = texts.join(own, "id", "left")
    return joined.select("id", "text", "chain", "fixes").mapInPandas(run, f"id {docs.schema[id_col].dataType.simpleString()}, text string, n_replaced int, chain string")
