"""SQL that the queries are checked against, where SQL expresses them."""



def _crc32(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes: each byte is taken in, then eight bits are shifted out."""
    hexed = f"hex(encode({text}))"
    steps = (
        f"flatten(list_transform(range(0, length({hexed}), 2), lambda p: "
        f"[('0x' || substring({hexed}, CAST(p + 1 AS INTEGER), 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    )
    step = "CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce({steps}, lambda c, e: {step}, 4294967295::BIGINT), 4294967295)"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _ways(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _then(state: str, cost: str, letter: str, line: str | None) -> str:
    """A state's cost, audit and lines after one more edit."""
    out = f"list_append({state}.lines, {line})" if line else f"{state}.lines"
    return f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'lines': {out}}}"


def _inserted(role: str, state: str) -> str:
    return _then(state, "2", "I", f"'{role}:'")


def _stepped(own: str, role: str, sources: str, initial: str) -> str:
    """The best way into a state that a turn of ``role`` leads to, before insertions."""
    ways = [_then(own, "3", "D", None)]
    for source in sources:
        kept = _then(source, "extra", "K", "role || ':' || text")
        turned = _then(source, "2 + extra", "R", f"'{role}:' || text")
        ways.append(f"CASE WHEN stays AND left(role, 1) = '{initial}' THEN {kept} ELSE far END")
        ways.append(f"CASE WHEN stays THEN {turned} ELSE far END")
    return _ways(*ways)


_FAR = "{'cost': 1000000000::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}"
_NONE = "{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}"
_BLANKS = r"\x20\x09-\x0D"

ORACLE = {
    # States: z before any turn, s after a system turn, u after a user's, a after an assistant's.
    "op11_turn_repair": f"""
        WITH RECURSIVE drawn AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {_crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS draw
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS again
            FROM drawn WHERE draw <> 0
        ), ordered AS (
            SELECT *, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substring(text, 1, 64), md5(text)) AS k
            FROM damaged
        ), seen AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS nth FROM ordered
        ), faulty AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_BLANKS}]') THEN 1 WHEN nth > 1 THEN 2
                           WHEN NOT regexp_matches(text, '[.!?][{_BLANKS}]*$') THEN 3 ELSE 0 END AS fault,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) AS two
            FROM seen
        ), walk AS (
            SELECT conv_id, 0::BIGINT AS k, {_NONE} AS z, {_FAR} AS s, {_inserted("user", _NONE)} AS u,
                   {_inserted("assistant", _inserted("user", _NONE))} AS a
            FROM (SELECT DISTINCT conv_id FROM faulty)
            UNION ALL
            SELECT conv_id, k, z, s, {_ways("u", _inserted("user", "z"), _inserted("user", "s"), _inserted("user", "a"))},
                   {_ways("a", _inserted("assistant", "u"), _inserted("assistant", _inserted("user", "z")),
                          _inserted("assistant", _inserted("user", "s")))}
            FROM (
                SELECT conv_id, k, {_then("z", "3", "D", None)} AS z,
                       {_ways(_then("s", "3", "D", None),
                              "CASE WHEN stays AND left(role, 1) = 's' THEN "
                              + _then("z", "extra", "K", "role || ':' || text") + " ELSE far END")} AS s,
                       {_stepped("u", "user", "zsa", "u")} AS u, {_stepped("a", "assistant", "u", "a")} AS a
                FROM (
                    SELECT f.conv_id, f.k, f.role, f.text, z, s, u, a, fault NOT IN (1, 2) AS stays,
                           CASE WHEN fault = 3 THEN 1 ELSE 0 END AS extra, {_FAR} AS far
                    FROM walk JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.k = walk.k + 1
                )
            )
        ), told AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                   count(*) FILTER (fault = 3) AS truncated,
                   count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS last
            FROM faulty GROUP BY conv_id
        ), ended AS (
            SELECT told.*, {_ways("z", "a")} AS best
            FROM told JOIN walk ON told.conv_id IS NOT DISTINCT FROM walk.conv_id AND told.last = walk.k
        )
        SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
               sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) i
        LEFT JOIN ended e ON i.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
    "op12_spelling": f"""
        WITH RECURSIVE runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
                   unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]+')) AS run
            FROM documents
        ), counted AS (
            SELECT doc, run, count(*) AS k FROM runs WHERE length(run) >= 5 GROUP BY doc, run
        ), drawn AS (
            SELECT run, k, {_crc32("concat(doc, ':', run)")} AS h FROM counted
        ), damaged AS (
            SELECT CASE WHEN h % 97 = 0
                        THEN substring(run, 1, CAST(h % length(run) AS INTEGER))
                             || substring(run, CAST(h % length(run) AS INTEGER) + 2)
                        ELSE run END AS word, k
            FROM drawn
        ), words AS (
            SELECT word, CAST(sum(k) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
        ), cut AS (
            SELECT word, n, i, substring(word, 1, CAST(i AS INTEGER)) || substring(word, CAST(i AS INTEGER) + 2) AS rest
            FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
        ), near AS (
            SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
            UNION
            SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
            UNION
            SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
        ), best AS (
            SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS most FROM near GROUP BY word
        ), formed AS (
            SELECT word, words.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN most >= 2 * words.n THEN other END AS form,
                   CASE WHEN most >= 2 * words.n THEN most END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), chain AS (
            SELECT word, form AS at FROM formed WHERE form IS NOT NULL
            UNION ALL
            SELECT chain.word, formed.form FROM chain JOIN formed ON chain.at = formed.word WHERE formed.form IS NOT NULL
        ), ended AS (
            SELECT chain.word, chain.at AS root FROM chain JOIN formed ON chain.at = formed.word WHERE formed.form IS NULL
        )
        SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN ended USING (word)
    """,
    "op5_neighbours": """
        WITH usable AS (
            SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), sized AS (
            SELECT *, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b)) AS size FROM usable
        ), pairs AS (
            SELECT q.k, q.vec_id AS query_id, c.vec_id,
                   list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b)
                   / (q.size * c.size) AS score
            FROM sized q JOIN sized c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op8_decontaminate": r"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), item AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), item_window AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n,
                   array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS phrase
            FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS s FROM item WHERE len(w) > 0)
        ), doc_window AS (
            SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS phrase
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
                  FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)
        ), found AS (
            SELECT doc_id, item_id, s, n FROM doc_window JOIN item_window USING (n, phrase)
        ), hit AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated
        FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op13_vector_copies": """
        WITH RECURSIVE own AS (
            SELECT row_number() OVER () AS k, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v
            FROM embeddings
        ), sized AS (
            SELECT *, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b)) AS size FROM own
            WHERE v IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(v, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.k, b.k AS other FROM sized a JOIN sized b ON a.label = b.label AND len(a.v) = len(b.v) AND a.k <> b.k
            WHERE list_reduce(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]), lambda x, y: x + y)
                  / (a.size * b.size) >= 0.98
        ), reached AS (
            SELECT k, k AS at FROM own
            UNION
            SELECT reached.k, links.other FROM reached JOIN links ON reached.at = links.k
        ), component AS (
            SELECT reached.k, min(own.vec_id) AS component_id FROM reached JOIN own ON own.k = reached.at GROUP BY reached.k
        ), counted AS (
            SELECT k, count(*) AS n_links FROM links GROUP BY k
        )
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id,
               vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM own JOIN component USING (k) LEFT JOIN counted USING (k)
    """,
}
