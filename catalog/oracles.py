"""DuckDB SQL that computes each registered query from the tables alone.

RE2 has no look-ahead, so the pre-token rule "the last whitespace before a word belongs to it" is expressed by a
marker (U+E000, absent from the tables) ahead of that whitespace.
"""

from __future__ import annotations

from catalog.queries import (
    ARABIC, BASE_LEARNED, CHUNKS, CYRILLIC, EPOCHS, HAN, HUNDREDS, LANGUAGES, LEARNED, MAX_STEPS, SAMPLE_ROWS, SEGMENT_TURNS,
)
from tokenloom.constants import CHAT_TEMPLATE, FIRST_MERGE_ID, MAX_SEQ_LEN, SEED, SPECIAL_TOKENS
from tokenloom.functions.bytelevel import SYMBOL_BASE

# The byte alphabet, from its rule: printable bytes stand for themselves, the others for the characters from 256 on, and
# ids follow the five reserved tokens in the order of the characters.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_CHARS = {**{b: b for b in _SHOWN}, **{b: 256 + n for n, b in enumerate(_HIDDEN)}}
STAND_INS = [chr(_CHARS[b]) for b in range(256)]
BYTE_IDS = [5 + [*_SHOWN, *_HIDDEN].index(b) for b in range(256)]

_WS = r"\s\x0b\x{85}\p{Z}"
_WORD = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}\x{E000}]+|[" + _WS + r"]+"
).replace("'", "''")
_ID_LIST = "[" + ",".join(map(str, BYTE_IDS)) + "]"
_STAND_IN_LIST = "[" + ",".join(str(ord(c)) for c in STAND_INS) + "]"


def _prefixed(t: str) -> str:
    return f"(CASE WHEN {t} = '' OR starts_with({t}, ' ') THEN {t} ELSE ' ' || {t} END)"


def _words(t: str) -> str:
    marked = f"regexp_replace({_prefixed(t)}, '([{_WS}])([{_WS}])([^{_WS}])', '\\1' || chr(57344) || '\\2\\3', 'g')"
    return f"regexp_extract_all({marked}, '{_WORD}')"


def _bytes(t: str) -> str:
    """List of byte values."""
    return f"list_transform(regexp_extract_all(hex(encode({t})), '..'), lambda x: ('0x' || x)::INT)"


def _byte_ids(t: str) -> str:
    return f"list_transform({_bytes(t)}, lambda b: {_ID_LIST}[b + 1])"


def _stand_ins(t: str) -> str:
    return f"array_to_string(list_transform({_bytes(t)}, lambda b: chr({_STAND_IN_LIST}[b + 1])), '')"


def _symbols(t: str) -> str:
    return f"array_to_string(list_transform({_byte_ids(t)}, lambda i: chr(({SYMBOL_BASE} + i)::INT)), '')"


def _joined(items: str) -> str:
    return f"array_to_string({items}, ',')"


def _symbol_ids(s: str) -> str:
    return f"list_transform(string_split({s}, ''), lambda c: unicode(c) - {SYMBOL_BASE})"


def _padded(ids: str, length: int, pad: int) -> str:
    return (
        f"list_concat(list_slice({ids}, 1, {length}), "
        f"list_transform(range(greatest(0, {length} - len({ids}))), lambda i: {pad}))"
    )


def _masked(prompt: str, answer: str) -> str:
    return f"list_concat(list_transform(range(len({prompt})), lambda i: -100), {answer})"


def _hash(*keys: str) -> str:
    return "md5('" + f"{SEED}:' || " + " || ':' || ".join(keys) + ")"


_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) || chr(10) AS line FROM documents"


def _line_words(table: str) -> str:
    return f"""
    lines_{table} AS (SELECT unnest(string_split(text, chr(10))) || chr(10) AS line FROM {table}),
    words_{table} AS MATERIALIZED (
        SELECT word, count(*) AS n FROM (SELECT unnest({_words('line')}) AS word FROM lines_{table}) GROUP BY word)"""


_PAIR_LIST = "list_transform(range(1, length(s)), lambda i: substring(s, i, 2))"


def _merge_ctes(table: str, count: int) -> str:
    """Plain one-merge-at-a-time training: pairs p1, p2, ... and word tables w0, w1, ..."""
    parts = [_line_words(table), f"{table}_w0 AS MATERIALIZED (SELECT {_symbols('word')} AS s, n FROM words_{table})"]
    for i in range(1, count + 1):
        parts.append(
            f"""{table}_p{i} AS MATERIALIZED (
        SELECT pair, sum(n)::BIGINT AS n FROM (SELECT unnest({_PAIR_LIST}) AS pair, n FROM {table}_w{i - 1})
        GROUP BY pair ORDER BY n DESC, pair LIMIT 1),
    {table}_w{i} AS MATERIALIZED (
        SELECT replace(s, (SELECT pair FROM {table}_p{i}), chr({SYMBOL_BASE + FIRST_MERGE_ID + i - 1})) AS s, n
        FROM {table}_w{i - 1})"""
        )
    rows = " UNION ALL ".join(
        f"SELECT {i - 1} AS rank, unicode(pair) - {SYMBOL_BASE} AS l, unicode(substring(pair, 2, 1)) - {SYMBOL_BASE} AS r, "
        f"{FIRST_MERGE_ID + i - 1} AS new_id, n AS cnt FROM {table}_p{i}"
        for i in range(1, count + 1)
    )
    parts.append(f"{table}_merges AS MATERIALIZED ({rows})")
    return ",".join(parts)


def _recursive_ctes(table: str, count: int, first_id: int = FIRST_MERGE_ID, start: str | None = None) -> str:
    """The same in a recursion: ``{table}_merges``, and ``{table}_final`` with every word of the lines and of the whole texts after all merges.

    ``start`` gives the symbols of ``word`` before the first merge.
    """
    return f"""{_line_words(table)},
    all_{table} AS MATERIALIZED (
        SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT word, n FROM words_{table} UNION ALL SELECT DISTINCT unnest({_pieces('text')}), 0 FROM {table})
        GROUP BY word),
    begun_{table} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY word) AS k, word, {start or _symbols('word')} AS s, n FROM all_{table}),
    state_{table}(k, step, s, n) USING KEY (k) AS (
        SELECT k, 0, s, n FROM begun_{table}
        UNION
        (WITH best AS (
            SELECT pair, sum(n)::BIGINT AS n FROM (SELECT unnest({_PAIR_LIST}) AS pair, n FROM state_{table} WHERE k > 0)
            GROUP BY pair ORDER BY n DESC, pair LIMIT 1)
        SELECT k, step + 1, replace(s, pair, chr(({SYMBOL_BASE + first_id} + step)::INT)), w.n
        FROM state_{table} w, best WHERE k > 0 AND step < {count}
        UNION ALL
        SELECT -1 - done, done, pair, n FROM best, (SELECT max(step) AS done FROM state_{table} WHERE k > 0) WHERE done < {count})),
    {table}_merges AS MATERIALIZED (
        SELECT step AS rank, unicode(s) - {SYMBOL_BASE} AS l, unicode(substring(s, 2, 1)) - {SYMBOL_BASE} AS r, {first_id} + step AS new_id, n AS cnt
        FROM state_{table} WHERE k < 0),
    {table}_final AS MATERIALIZED (SELECT b.word, f.s FROM state_{table} f JOIN begun_{table} b USING (k))"""


_SPECIAL_ROWS = ", ".join(f"({i}, '{t}')" for i, t in enumerate(SPECIAL_TOKENS))
_BYTE_ROWS = ", ".join(f"({b}, chr({ord(STAND_INS[b])}), {BYTE_IDS[b]})" for b in range(256))


def _vocab_ctes(table: str, count: int) -> str:
    """Vocabulary as ids, texts and bytes; merged texts follow from expanding symbols in rank order."""
    parts = [
        f"{table}_t0 AS (SELECT * FROM (VALUES {_SPECIAL_ROWS}) v(id, token) UNION ALL "
        f"SELECT id, token FROM (VALUES {_BYTE_ROWS}) v(byte, token, id))"
    ]
    for i in range(1, count + 1):
        parts.append(
            f"""{table}_t{i} AS MATERIALIZED (SELECT * FROM {table}_t{i - 1} UNION ALL
        SELECT m.new_id, a.token || b.token FROM {table}_merges m JOIN {table}_t{i - 1} a ON a.id = m.l
        JOIN {table}_t{i - 1} b ON b.id = m.r WHERE m.rank = {i - 1})"""
        )
    kind = f"CASE WHEN id < {len(SPECIAL_TOKENS)} THEN 'special' WHEN id < {FIRST_MERGE_ID} THEN 'byte' ELSE 'merge' END"
    parts.append(f"{table}_vocab AS (SELECT id::INT AS id, token, {kind} AS kind FROM {table}_t{count})")
    return ",".join(parts)


def _replaced(s: str, table: str, count: int) -> str:
    for i in range(1, count + 1):
        s = f"replace({s}, (SELECT pair FROM {table}_p{i}), chr({SYMBOL_BASE + FIRST_MERGE_ID + i - 1}))"
    return s


def _encoded_ctes(name: str, source: str, keys: str, words: str | None = None) -> str:
    """``{name}``: rows of ``source`` (keys, text t) with ``ids``, the learned merges applied to each distinct word.

    ``words`` is a query for ``word`` and its merged symbols ``s``, else the merges learned from ``documents`` are applied.
    """
    if words is None:
        words = f"SELECT word, {_replaced('s', 'documents', LEARNED)} AS s FROM (SELECT word, {_symbols('word')} AS s FROM (SELECT DISTINCT word FROM {name}_tok))"
    on = " AND ".join(f"x.{k.strip()} = y.{k.strip()}" for k in keys.split(","))
    return f"""
    {name}_src AS MATERIALIZED ({source}),
    {name}_tok AS MATERIALIZED (
        SELECT {keys}, unnest(words) AS word, generate_subscripts(words, 1) AS pos
        FROM (SELECT {keys}, {_pieces('t')} AS words FROM {name}_src)),
    {name}_dist AS MATERIALIZED (
        SELECT word, CASE word {' '.join(f"WHEN '{t}' THEN [{i}]" for i, t in enumerate(SPECIAL_TOKENS))}
            ELSE {_symbol_ids('s')} END AS part
        FROM ({words})),
    {name}_cat AS (
        SELECT {keys}, flatten(list(part ORDER BY pos)) AS ids
        FROM {name}_tok JOIN {name}_dist USING (word) GROUP BY {keys}),
    {name} AS MATERIALIZED (
        SELECT x.* EXCLUDE (t), coalesce(y.ids, []) AS ids FROM {name}_src x LEFT JOIN {name}_cat y ON {on})"""


def _pieces(t: str) -> str:
    """Words with reserved tokens kept whole, cut at an inserted separator (U+E001)."""
    special = "|".join(SPECIAL_TOKENS)
    cut = f"string_split(regexp_replace({t}, '({special})', chr(57345) || '\\1' || chr(57345), 'g'), chr(57345))"
    in_list = ", ".join(f"'{s}'" for s in SPECIAL_TOKENS)
    return (
        f"flatten(list_transform(list_filter({cut}, lambda p: p <> ''), "
        f"lambda p: CASE WHEN p IN ({in_list}) THEN [p] ELSE {_words('p')} END))"
    )


_INSTRUCT = """
    instruct_rows AS (
        SELECT u.conv_id, u.turn, s.text AS instruct, u.text AS input, a.text AS output
        FROM conversations u
        LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
        LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = 0 AND s.role = 'system'
        WHERE u.role = 'user'),
    answered AS (SELECT * FROM instruct_rows WHERE output IS NOT NULL)"""

_PROMPT = (
    "coalesce(instruct, '') || CASE WHEN coalesce(input, '') = '' THEN '' "
    "ELSE '<s>user' || chr(10) || input || '</s>' || chr(10) || '<s>assistant' || chr(10) END"
)
_ANSWER = "output || '</s>' || chr(10)"

_L = MAX_SEQ_LEN


def _trained(*ctes: str, select: str) -> str:
    return "WITH " + ",".join([_merge_ctes("documents", LEARNED), *ctes]) + " " + select


def _pretrain_select(compat: bool = False) -> str:
    """From encoded documents ``enc`` to padded and shifted rows; follows a list of tables."""
    ids = "list_concat([0], ids, [1])"
    if compat:
        ids = f"list_concat([0], {ids}, [1])"
    label = "output_ids" if compat else "labels"
    return (
        f", seq AS (SELECT doc_id, {_padded('i', _L, -100 if compat else 2)} AS a, {_padded('i', _L, -100)} AS b "
        f"FROM (SELECT doc_id, {ids} AS i FROM enc)) SELECT doc_id, {_joined(f'list_slice(a, 1, {_L - 1})')} AS input_ids, "
        f"{_joined(f'list_slice(b, 2, {_L})')} AS {label} FROM seq"
    )


def _pretrain_sql(compat: bool) -> str:
    return _trained(_encoded_ctes("enc", "SELECT doc_id, lang, text AS t FROM documents", "doc_id"), select="") + _pretrain_select(compat)


def _chat_sides() -> list[str]:
    return [
        _INSTRUCT,
        _encoded_ctes("p", f"SELECT conv_id, turn, {_PROMPT} AS t FROM answered", "conv_id, turn"),
        _encoded_ctes("a", f"SELECT conv_id, turn, {_ANSWER} AS t FROM answered", "conv_id, turn"),
        "both_sides AS (SELECT conv_id, turn, p.ids AS p, a.ids AS a FROM p JOIN a USING (conv_id, turn))",
    ]


def _instruct_sql(compat: bool) -> str:
    inputs = "p" if compat else "list_concat(p, a)"
    return _trained(
        *_chat_sides(),
        f"seq AS (SELECT conv_id, turn, {inputs} AS i, {_masked('p', 'a')} AS l FROM both_sides)",
        select=f"SELECT conv_id, turn, {_joined(_padded('i', _L, 1))} AS input_ids, {_joined(_padded('l', _L, 1))} AS labels FROM seq",
    )


def _chunk_sql(select: str) -> str:
    return f"""WITH ranked AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS total FROM documents),
    sized AS (SELECT *, total // {CHUNKS} AS q, total % {CHUNKS} AS rem FROM ranked),
    chunked AS (SELECT *, (CASE WHEN r < rem * (q + 1) THEN r // (q + 1) ELSE rem + (r - rem * (q + 1)) // greatest(q, 1) END)::INT AS chunk
        FROM sized) {select}"""


def _permuted_ctes(epochs: int) -> str:
    """``permuted``: rank of every document and epoch. Positions follow descending ids; a walk goes on until it is below n."""
    # six rounds add a hash of one digit to the other, in turn
    turns = ""
    for turn in range(6):
        other, own, base = ("r", "l", "a") if turn % 2 else ("l", "r", "b")
        added = f"({own} + ('0x' || substring(md5('{SEED}:' || epoch || ':{turn}:' || {other}), 1, 12))::BIGINT % {base}) % {base}"
        source = "SELECT doc_id, epoch, steps, n, a, b, p // b AS l, p % b AS r FROM walks WHERE steps = 0 OR p >= n" if turn == 0 else f"SELECT * FROM ({turns})"
        kept = f"{added} AS l, r" if turn % 2 else f"l, {added} AS r"
        turns = f"SELECT doc_id, epoch, steps, n, a, b, {kept} FROM ({source})"
    return f"""positions AS (
        SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) - 1 AS p, count(*) OVER () AS n FROM documents),
    sides AS (SELECT *, floor(sqrt(greatest(n - 1, 0)))::BIGINT + 1 AS a FROM positions),
    walks AS (
        SELECT doc_id, epoch, 0 AS steps, n, a, greatest((n + a - 1) // a, 1) AS b, p FROM sides, range({epochs}) e(epoch)
        UNION ALL
        SELECT doc_id, epoch, steps + 1, n, a, b, l * b + r FROM ({turns})),
    permuted AS (SELECT doc_id, epoch * n + p AS rank FROM walks WHERE steps > 0 AND p < n)"""


def all_sql() -> dict[str, str]:
    sample = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {{0}} ORDER BY {_hash('doc_id')}, doc_id) AS r
        FROM documents) WHERE r <= {SAMPLE_ROWS}"""
    ranked = f"SELECT *, row_number() OVER (ORDER BY {_hash('doc_id')}, doc_id) - 1 AS rank FROM documents"
    sql: dict[str, str] = {}

    sql["sampled_languages"] = (
        f"SELECT lang, count(*) AS rows, sum(length('<s>' || text || '</s>'))::BIGINT AS chars "
        f"FROM ({sample.format('lang')}) GROUP BY lang"
    )
    sql["scan_subsets"] = "SELECT doc_id, lang, text FROM documents WHERE lang IN ('en', 'fr', 'es')"
    sql["scan_instruct"] = f"WITH {_INSTRUCT} SELECT instruct AS instruction, input, output FROM answered"
    sql["jsonl_roundtrip"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
    sql["chunk_roundtrip"] = _chunk_sql(
        "SELECT chunk, line, count(*) AS n FROM (SELECT chunk, unnest(string_split(text, chr(10))) || chr(10) AS line FROM chunked) "
        "GROUP BY chunk, line"
    )
    sql["corpus_lines"] = _LINES
    sql["drop_columns"] = "SELECT doc_id, text, lang FROM documents"
    sql["instruct_schema"] = f"WITH {_INSTRUCT} SELECT conv_id, turn, instruct, input, output FROM answered"
    sql["title_text"] = sql["map_batches"] = "SELECT doc_id, coalesce(source, '') || ' ' || text AS text FROM documents"
    sql["wrap_text"] = "SELECT doc_id, '<s>' || text || '</s>' AS text FROM documents"
    sql["instruct_messages"] = (
        f"WITH {_INSTRUCT} SELECT conv_id, turn, concat_ws('|', 'system:' || nullif(instruct, ''), 'user:' || nullif(input, '')) AS prompt, "
        "'assistant:' || output AS answer FROM answered"
    )
    sql["union_sources"] = (
        "SELECT 'documents' AS origin, doc_id AS id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark"
    )
    sql["rejected_rows"] = (
        f"WITH {_INSTRUCT} SELECT conv_id, turn, CASE WHEN coalesce(instruct, '') = '' AND coalesce(input, '') = '' THEN 'no_prompt' "
        "WHEN output IS NULL THEN 'no_output' ELSE '' END AS reject_reason FROM instruct_rows"
    )
    sql["shuffle_rank"] = f"SELECT doc_id, rank FROM ({ranked})"
    sql["sample_per_subset"] = f"SELECT doc_id, lang, text FROM ({sample.format('lang')})"
    sql["sample_per_subset_unlisted"] = f"SELECT doc_id, source, text FROM ({sample.format('source')})"
    sql["split_exact"] = (
        f"SELECT doc_id, CASE WHEN rank < ceil(0.05 * total) THEN 'test' ELSE 'train' END AS part "
        f"FROM (SELECT *, count(*) OVER () AS total FROM ({ranked}))"
    )
    sql["split_per_subset"] = (
        f"SELECT doc_id, lang, CASE WHEN r <= ceil(0.1 * total) THEN 'test' ELSE 'train' END AS part FROM (SELECT *, "
        f"row_number() OVER (PARTITION BY lang ORDER BY {_hash('doc_id')}, doc_id) AS r, count(*) OVER (PARTITION BY lang) AS total "
        "FROM documents)"
    )
    limit = format(int(2**32 * 5 // 100), "08x")
    sql["split_hash"] = (
        f"SELECT doc_id, CASE WHEN substring({_hash('doc_id')}, 1, 8) < '{limit}' THEN 'test' ELSE 'train' END AS part FROM documents"
    )
    sql["head_fraction"] = (
        "SELECT doc_id, text FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS total FROM documents) "
        "WHERE r < round_even(total * 0.5, 0)"
    )
    sql["corpus_chunks"] = _chunk_sql("SELECT doc_id, chunk FROM chunked")
    sql["corpus_chunks_compat"] = _chunk_sql(
        f"SELECT doc_id, i::INT AS chunk FROM sized, range({CHUNKS}) g(i) WHERE r < q + CASE WHEN i < rem THEN 1 ELSE 0 END"
    )
    sql["assign_batches"] = f"SELECT doc_id, rank, rank // 32 AS micro_batch, rank // 256 AS step FROM ({ranked})"
    sql["collect_batches"] = (
        "SELECT rank // 256 AS step, rank // 32 AS micro_batch, string_agg(doc_id::VARCHAR, ',' ORDER BY rank) AS doc_ids, "
        f"string_agg(n_chars::VARCHAR, ',' ORDER BY rank) AS sizes FROM ({ranked}) GROUP BY 1, 2"
    )
    sql["pretokenize"] = (
        f"SELECT doc_id, len(w)::BIGINT AS n, array_to_string(w, '|') AS words FROM (SELECT doc_id, {_words('text')} AS w FROM documents)"
    )
    sql["word_counts"] = f"WITH {_line_words('documents')} SELECT word, n FROM words_documents"
    sql["byte_alphabet"] = f"SELECT doc_id, {_stand_ins('text')} AS symbols, {_joined(_byte_ids('text'))} AS ids FROM documents"
    sql["byte_counts"] = (
        f"WITH {_line_words('documents')}, c AS (SELECT b, sum(n)::BIGINT AS n FROM (SELECT unnest({_bytes('word')}) AS b, n "
        f"FROM words_documents) GROUP BY b) SELECT v.byte::INT AS byte, v.stand_in, v.id::INT AS id, coalesce(c.n, 0)::BIGINT AS n "
        f"FROM (VALUES {_BYTE_ROWS}) v(byte, stand_in, id) LEFT JOIN c ON c.b = v.byte"
    )
    sql["pair_counts"] = (
        f"WITH {_line_words('documents')}, w AS (SELECT {_symbols('word')} AS s, n FROM words_documents) "
        f"SELECT (unicode(pair) - {SYMBOL_BASE})::INT AS \"left\", (unicode(substring(pair, 2, 1)) - {SYMBOL_BASE})::INT AS \"right\", "
        f"sum(n)::BIGINT AS n FROM (SELECT unnest({_PAIR_LIST}) AS pair, n FROM w) GROUP BY pair"
    )
    merge_columns = 'rank::INT AS rank, l::INT AS "left", r::INT AS "right", new_id::INT AS new_id, cnt AS "count"'
    sql["bpe_merges"] = _trained(select=f"SELECT {merge_columns} FROM documents_merges")
    vocab = _vocab_ctes("documents", LEARNED)
    code_points = "[" + ",".join(f"'{ord(c):x}'" for c in STAND_INS) + "]"
    token_bytes = (
        f"array_to_string(list_transform(string_split(token, ''), "
        f"lambda c: printf('%02X', list_position({code_points}, printf('%x', unicode(c))) - 1)), '')"
    )
    sql["vocab"] = _trained(vocab, select=f"SELECT id, token, kind, {token_bytes} AS bytes FROM documents_vocab")
    sql["vocab_export"] = _trained(
        vocab,
        select='SELECT v.id, v.token, v.kind, m.rank::INT AS rank, m.l::INT AS "left", m.r::INT AS "right", m.cnt AS "count" '
        "FROM documents_vocab v LEFT JOIN documents_merges m ON m.new_id = v.id",
    )
    sql["vocab_import"] = _trained(vocab, select="SELECT token, id FROM documents_vocab")
    sql["vocab_merge"] = _trained(
        vocab, _merge_ctes("benchmark", BASE_LEARNED), _vocab_ctes("benchmark", BASE_LEARNED),
        select="SELECT id, token, kind FROM benchmark_vocab UNION ALL SELECT ((SELECT max(id) FROM benchmark_vocab) + "
        "row_number() OVER (ORDER BY id))::INT, token, kind FROM documents_vocab WHERE token NOT IN (SELECT token FROM benchmark_vocab)",
    )
    sql["special_tokens"] = (
        f"SELECT v.id::INT AS id, v.content, true AS special, (SELECT sum(len(list_filter({_pieces(chr(39) + '<s>' + chr(39) + ' || text || ' + chr(39) + '</s>' + chr(39))}, "
        f"lambda p: p = v.content)))::BIGINT FROM documents) AS n FROM (VALUES {_SPECIAL_ROWS}) v(id, content)"
    )
    docs = _encoded_ctes("enc", "SELECT doc_id, lang, length(text) AS chars, text AS t FROM documents", "doc_id")
    sql["encode"] = _trained(docs, select=f"SELECT doc_id, {_joined('list_concat([0], ids, [1])')} AS ids FROM enc")
    sql["special_split"] = (
        f"SELECT doc_id, array_to_string(list_concat(['<s>'], {_words('source')}, ['</s>'], {_words('text')}, ['<mask>'], "
        f"{_words('lang')}), '|') AS words FROM documents"
    )
    sql["add_bos_eos"] = f"SELECT doc_id, {_joined(f'list_concat([0], ' + _byte_ids('text') + ', [1])')} AS ids FROM documents"
    sql["decode"] = (
        f"SELECT doc_id, '<s>' || {_prefixed('text')} || '</s>' AS text, {_prefixed('text')} AS plain FROM documents"
    )
    sql["roundtrip"] = _trained(
        docs,
        select="SELECT lang, count(*) AS rows, 0::BIGINT AS mismatches, sum(len(ids))::BIGINT AS tokens, "
        "round(sum(chars)::DOUBLE / sum(len(ids)), 6) AS chars_per_token FROM enc GROUP BY lang",
    )
    turn_pieces = """SELECT conv_id, turn, piece FROM (
        SELECT conv_id, turn, CASE role WHEN 'user' THEN '<s>user' || chr(10) || text || '</s>' || chr(10) || '<s>assistant' || chr(10)
            WHEN 'assistant' THEN text || '</s>' || chr(10)
            WHEN 'system' THEN CASE WHEN turn = first_turn THEN text END END AS piece
        FROM (SELECT *, min(turn) OVER (PARTITION BY conv_id) AS first_turn FROM conversations)) WHERE piece IS NOT NULL"""
    sql["chat_turns"] = turn_pieces
    sql["chat_render"] = (
        f"SELECT conv_id, turn // {SEGMENT_TURNS} AS segment, string_agg(piece, '' ORDER BY turn) AS text FROM ({turn_pieces}) GROUP BY 1, 2"
    )
    sql["chat_render_rows"] = f"WITH {_INSTRUCT} SELECT conv_id, turn, {_PROMPT} AS prompt, {_ANSWER} AS answer FROM answered"
    sql["chat_encode"] = _trained(
        *_chat_sides(), select=f"SELECT conv_id, turn, {_joined('p')} AS prompt, {_joined('a')} AS answer FROM both_sides"
    )
    sql["pad_truncate"] = (
        f"SELECT doc_id, {_joined(_padded('i', _L, -100))} AS ids FROM (SELECT doc_id, {_byte_ids('text')} AS i FROM documents)"
    )
    sql["pretrain_rows"] = sql["stream_pretrain"] = _pretrain_sql(compat=False)
    sql["pretrain_rows_compat"] = _pretrain_sql(compat=True)
    sql["training_batches"] = (
        f"SELECT doc_id, rank, rank // 32 AS micro_batch, rank // 256 AS step, input_ids, labels "
        f"FROM ({_pretrain_sql(compat=False)}) JOIN (SELECT doc_id, rank FROM ({ranked})) USING (doc_id)"
    )
    sql["instruct_labels"] = (
        f"WITH {_INSTRUCT} SELECT conv_id, turn, {_joined(_masked('p', 'a'))} AS labels FROM "
        f"(SELECT conv_id, turn, {_byte_ids('input')} AS p, {_byte_ids('output')} AS a FROM answered)"
    )
    sql["instruct_rows"] = sql["stream_instruct"] = _instruct_sql(compat=False)
    sql["instruct_rows_compat"] = _instruct_sql(compat=True)
    sql["supervised_tokens"] = _trained(
        docs,
        select=f"SELECT lang, count(*) AS rows, sum(k)::BIGINT AS tokens, round(avg(k), 6) AS mean_tokens FROM "
        f"(SELECT lang, least(len(ids) + 2, {_L}) - 1 AS k FROM enc) GROUP BY lang",
    )
    sql["id_domain"] = _trained(docs, select=f"SELECT doc_id, len(ids) + 4 >= {_L - 1} AS usable FROM enc")
    usable = f"len(list_filter(list_slice(list_concat([0], ids, [1]), 1, {_L - 1}), lambda i: i >= {FIRST_MERGE_ID + LEARNED - 2})) = 0"
    sql["id_domain_small"] = _trained(docs, select=f"SELECT doc_id, {usable} AS usable FROM enc")
    sql["stream_rejects"] = "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'no_text' ELSE '' END AS reject_reason FROM documents"
    sql["chunk_rewrite"] = f"SELECT *, chunk IN (1, 4) AS written FROM ({sql['chunk_roundtrip']})"
    sql["training_batches_max_steps"] = f"SELECT * FROM ({sql['assign_batches']}) WHERE rank < {MAX_STEPS * 256}"
    sql["bpe_merges_small_bounds"] = sql["bpe_merges"]
    sql["bpe_merges_500"] = f"WITH RECURSIVE {_recursive_ctes('documents', HUNDREDS)} SELECT {merge_columns} FROM documents_merges"
    sql["encode_500"] = (
        f"WITH RECURSIVE {_recursive_ctes('documents', HUNDREDS)}, "
        + _encoded_ctes("enc", "SELECT doc_id, text AS t FROM documents", "doc_id", "SELECT word, s FROM documents_final")
        + f" SELECT doc_id, {_joined('list_concat([0], ids, [1])')} AS ids FROM enc"
    )
    sql["pretrain_rows_500"] = (
        f"WITH RECURSIVE {_recursive_ctes('documents', HUNDREDS)}, "
        + _encoded_ctes("enc", "SELECT doc_id, lang, text AS t FROM documents", "doc_id", "SELECT word, s FROM documents_final")
        + _pretrain_select()
    )
    based = _merge_ctes("benchmark", BASE_LEARNED)
    sql["vocab_recovered"] = (
        f"WITH {based}, {_vocab_ctes('benchmark', BASE_LEARNED)} SELECT v.id, v.token, m.l::INT AS \"left\", m.r::INT AS \"right\" "
        "FROM benchmark_vocab v JOIN benchmark_merges m ON m.new_id = v.id"
    )
    merged = _replaced("s", "benchmark", BASE_LEARNED)
    sql["encode_base"] = (
        f"WITH {based}, "
        + _encoded_ctes(
            "enc", "SELECT doc_id, text AS t FROM documents", "doc_id",
            f"SELECT word, {merged} AS s FROM (SELECT word, {_symbols('word')} AS s FROM (SELECT DISTINCT word FROM enc_tok))",
        )
        + f" SELECT doc_id, {_joined('list_concat([0], ids, [1])')} AS ids FROM enc"
    )
    after = f"WITH RECURSIVE {based}, " + _recursive_ctes(
        "documents", LEARNED, FIRST_MERGE_ID + BASE_LEARNED, _replaced(_symbols("word"), "benchmark", BASE_LEARNED)
    )
    sql["bpe_merges_after_base"] = f"{after} SELECT {merge_columns} FROM documents_merges"
    # ids of the documents' merges go on where those of the base end, so one list of merges spells all tokens
    sql["vocab_after_base"] = (
        f"{after}, both_merges AS MATERIALIZED (SELECT * FROM benchmark_merges UNION ALL SELECT rank + {BASE_LEARNED}, l, r, new_id, cnt FROM documents_merges), "
        f"{_vocab_ctes('both', BASE_LEARNED + LEARNED)} SELECT id, token, kind FROM both_vocab"
    )
    sql["encode_after_base"] = (
        f"{after}, "
        + _encoded_ctes("enc", "SELECT doc_id, text AS t FROM documents", "doc_id", "SELECT word, s FROM documents_final")
        + f" SELECT doc_id, {_joined('list_concat([0], ids, [1])')} AS ids FROM enc"
    )
    sql["file_positions"] = "SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) - 1 AS position FROM documents"
    sql["file_head"] = sql["head_fraction"].replace("ORDER BY doc_id)", "ORDER BY doc_id DESC)")
    sql["file_chunks"] = sql["corpus_chunks"].replace("ORDER BY doc_id)", "ORDER BY doc_id DESC)")
    sql["file_chunks_compat"] = sql["corpus_chunks_compat"].replace("ORDER BY doc_id)", "ORDER BY doc_id DESC)").replace(
        "count(*) OVER () AS total", "round_even(count(*) OVER () * 0.5, 0)::BIGINT AS total"
    )
    sql["permuted_batches"] = (
        f"WITH RECURSIVE {_permuted_ctes(EPOCHS)} SELECT doc_id, rank, rank // 32 AS micro_batch, rank // 256 AS step FROM permuted"
    )
    sql["stream_steps"] = f"SELECT *, (step // 2)::INT AS batch FROM ({sql['permuted_batches']})"
    sql["step_rows"] = (
        f"WITH RECURSIVE {_permuted_ctes(1)} SELECT doc_id, rank, rank // 32 AS micro_batch, rank // 256 AS step, "
        f"(rank // 32 % 8 % 2)::INT AS process, input_ids, labels FROM ({_pretrain_sql(compat=False)}) JOIN permuted USING (doc_id) WHERE rank >= 256"
    )
    size = FIRST_MERGE_ID + BASE_LEARNED + 3
    sql["vocab_merge_sized"] = f"SELECT * FROM ({sql['vocab_merge']}) WHERE id < {size}"
    letters = "abcdefghijklmnopqrstuvwxyz"
    scripts = " || ".join(f"translate(lower(text), '{letters}', '{to}')" for to in (CYRILLIC, ARABIC, HAN))
    sql["roundtrip_scripts"] = _trained(
        _encoded_ctes("enc", f"SELECT doc_id, lang, length({scripts}) AS chars, {scripts} AS t FROM documents", "doc_id"),
        select="SELECT lang, count(*) AS rows, 0::BIGINT AS mismatches, sum(len(ids))::BIGINT AS tokens, "
        "round(sum(chars)::DOUBLE / sum(len(ids)), 6) AS chars_per_token FROM enc GROUP BY lang",
    )
    sized = "(SELECT *, n_chars // 100 AS size FROM documents)"
    for name, by, most in (("sample_repeated_keys", "lang", SAMPLE_ROWS), ("sample_repeated_keys_unlisted", "source", SAMPLE_ROWS // 10)):
        place = f"row_number() OVER (PARTITION BY {by} ORDER BY {_hash('size')}, size)"
        sql[name] = f"SELECT {by}, size, count(*) AS n FROM (SELECT *, {place} AS r FROM {sized}) WHERE r <= {most} GROUP BY 1, 2"
    sql["split_repeated_keys"] = (
        f"SELECT CASE WHEN r <= ceil(0.05 * total) THEN 'test' ELSE 'train' END AS part, size, count(*) AS n FROM (SELECT *, "
        f"row_number() OVER (ORDER BY {_hash('size')}, size) AS r, count(*) OVER () AS total FROM {sized}) GROUP BY 1, 2"
    )
    sql["chunks_repeated_keys"] = _chunk_sql("SELECT chunk, size, count(*) AS n FROM chunked GROUP BY 1, 2").replace(
        "ORDER BY doc_id", "ORDER BY n_chars // 100"
    ).replace("SELECT *, row_number()", "SELECT *, n_chars // 100 AS size, row_number()")
    listed = "[" + ", ".join(f"'{x}'" for x in LANGUAGES) + "]"
    n = len(LANGUAGES)
    sql["tokenizer_sample"] = f"""WITH picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_hash('doc_id')}, doc_id) AS k,
            count(*) OVER (PARTITION BY lang) AS c FROM documents) WHERE k <= ceil(0.1 * c)),
        ranked AS (SELECT *, row_number() OVER (ORDER BY list_position({listed}, lang), {_hash('doc_id')}, doc_id) - 1 AS r, count(*) OVER () AS total FROM picked),
        sized AS (SELECT *, total // {n} AS q, total % {n} AS rem FROM ranked)
        SELECT lang AS subset, source || ' ' || text AS text, n_chars,
            (CASE WHEN r < rem * (q + 1) THEN r // (q + 1) ELSE rem + (r - rem * (q + 1)) // greatest(q, 1) END)::INT AS chunk FROM sized"""
    template = CHAT_TEMPLATE.replace("'", "''")
    sql["settings"] = f"""SELECT id, content, false AS lstrip, false AS normalized, false AS rstrip, false AS single_word, true AS special,
        '<s>' AS bos_token, '</s>' AS eos_token, '<unk>' AS unk_token, NULL::VARCHAR AS pad_token, false AS add_bos_token, true AS add_prefix_space,
        true AS legacy, 'PreTrainedTokenizerFast' AS tokenizer_class, '1000000000000000019884624838656' AS model_max_length, 0::INT AS more,
        md5('{template}') AS template, n FROM ({sql['special_tokens']})"""
    return sql
