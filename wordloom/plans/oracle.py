"""The same queries as SQL for a second engine; fixed values mirror those of the operators and the label stub."""

UNKNOWN = "'tidak diketahui'"

_WORDS = r"""
words AS (
  SELECT word FROM (
    SELECT regexp_replace(piece, '[^\p{L}]', '', 'g') AS word FROM (
      SELECT unnest(string_split_regex(lower(token), '[,;]')) AS piece FROM (
        SELECT unnest(string_split(replace(text, ', ', ' '), ' ')) AS token FROM documents)))
  WHERE word <> ''),
freq AS (SELECT word, count(*)::BIGINT AS frequency FROM words GROUP BY word)"""


def _unescaped(text: str) -> str:
    for reference, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"),
        ("&middot;", "·"),
    ):
        text = f"replace({text}, '{reference}', '{character}')"
    return text


def _stripped(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def _decoded(text: str) -> str:
    """As a browser reads it: the ampersand's semicolon may be missing."""
    return f"regexp_replace({_unescaped(text)}, '&amp;?', '&', 'g')"


_VISIBLE = _stripped(rf"regexp_replace({_decoded('bare')}, '[\s\x{{A0}}]+', ' ', 'g')")
_PAGE_TEXT = rf"""
page_text AS (
  SELECT page_id, {_VISIBLE} AS text FROM (
    SELECT page_id, regexp_replace(regexp_replace(html,
      '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), '<[^>]*>', ' ', 'g') AS bare
    FROM pages))"""
_PAGE_WORDS = r"""
page_words AS (
  SELECT word FROM (
    SELECT regexp_replace(piece, '[^\p{L}]', '', 'g') AS word FROM (
      SELECT unnest(string_split_regex(lower(text), '[ ,;]')) AS piece FROM page_text))
  WHERE word <> '')"""

_LABELS = f"""
ranked AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS r FROM freq),
first_labels AS (
  SELECT a.r AS seq, a.word, 'def ' || a.r AS definition,
    CASE WHEN a.r % 5 = 0 THEN {UNKNOWN} WHEN a.r % 11 = 0 THEN a.word ELSE coalesce(t.word, {UNKNOWN}) END AS antonym,
    CASE WHEN a.r % 4 = 0 THEN {UNKNOWN} WHEN a.r % 7 = 0 THEN a.word ELSE coalesce(s.word, {UNKNOWN}) END AS synonym,
    ['kata nama', 'kata kerja', 'kata adjektif', 'kata sendi', 'kata keterangan', 'bukan kategori'][a.r % 6 + 1] AS pos,
    CASE WHEN a.r % 13 = 0 THEN 'n/a' ELSE CAST(37 * a.r % 201 - 100 AS VARCHAR) END AS sentiment
  FROM ranked a
  LEFT JOIN ranked s ON s.r = 8 * (a.r // 8) + (3 * a.r + 1) % 8
  LEFT JOIN ranked t ON t.r = 8 * (a.r // 8) + (5 * a.r + 2) % 8),
labels AS (
  SELECT seq, word, definition, antonym, synonym, pos, sentiment FROM first_labels
  UNION ALL
  SELECT seq + 1000000, word, definition || ' v2', antonym, synonym, pos, sentiment FROM first_labels
  WHERE seq % 10 = 0),
valid AS (
  SELECT seq, word, definition, antonym, synonym, pos, CAST(sentiment AS DOUBLE) AS sentiment FROM labels
  WHERE sentiment <> 'n/a')"""

_EDGES = f"""
edges AS (
  SELECT DISTINCT word AS src, 'SYNONYM' AS rel, synonym AS dst FROM valid
  WHERE synonym <> {UNKNOWN} AND synonym <> word
  UNION ALL
  SELECT DISTINCT word, 'ANTONYM', antonym FROM valid WHERE antonym <> {UNKNOWN} AND antonym <> word)"""


def _nodes(order: str) -> str:
    return f"""
writes AS (
  SELECT word, seq, 0 AS step, definition, pos FROM valid
  UNION ALL
  SELECT synonym, seq, 1, definition, pos FROM valid WHERE synonym <> {UNKNOWN} AND synonym <> word),
last_writes AS (
  SELECT word, definition, pos FROM (
    SELECT word, definition, pos, row_number() OVER (PARTITION BY word ORDER BY {order}) AS n FROM writes)
  WHERE n = 1),
nodes AS (
  SELECT word, definition, pos FROM last_writes
  UNION ALL
  SELECT DISTINCT antonym, NULL, NULL FROM valid
  WHERE antonym <> {UNKNOWN} AND antonym <> word
    AND NOT EXISTS (SELECT 1 FROM last_writes l WHERE l.word = valid.antonym))"""


_NODES = _nodes("seq DESC, step DESC")

#: Labels are usable unless none of three fields says anything; of two runs the later one wins.
_USABLE = f"""
usable AS (
  SELECT * FROM valid WHERE {" OR ".join(
    f"NOT (contains(lower({c}), {UNKNOWN}) OR contains(lower({c}), 'nama'))" for c in ("definition", "antonym", "synonym"))})"""
_SECOND_RUN = "seq % 3 = 0 DESC, seq DESC"
_TWO_RUNS = (_USABLE, _nodes(f"{_SECOND_RUN}, step DESC").replace("FROM valid", "FROM usable").replace("valid.antonym", "usable.antonym"),
             _EDGES.replace("FROM valid", "FROM usable"))

_SENTIMENT = """
word_sentiment AS (
  SELECT word, sentiment FROM (
    SELECT word, sentiment, row_number() OVER (PARTITION BY word ORDER BY seq DESC) AS n FROM valid)
  WHERE n = 1)"""

_BENCHMARK = r"""
keys AS (
  SELECT word FROM (
    SELECT regexp_replace(piece, '[^\p{L}]', '', 'g') AS word FROM (
      SELECT unnest(string_split_regex(lower(text), '[ ,;]')) AS piece FROM benchmark))
  WHERE word <> '')"""


def _answers(source: str) -> str:
    """The stub's label lines for the words of ``source``, 80 words a batch."""
    return f"""
numbered AS (SELECT word, row_number() OVER (ORDER BY word) AS n, length(word) AS size FROM {source}),
batched AS (SELECT word, size, n, (n - 1) // 80 AS batch_id FROM numbered),
answered AS (
  SELECT batch_id, word, size, n,
    CASE WHEN size % 9 = 0 THEN {UNKNOWN} WHEN size % 8 = 0 THEN 'kata nama ' || word
         WHEN size % 7 = 0 THEN 'makna ' || word || ', huraian' ELSE 'makna ' || word END AS definition,
    CASE WHEN size % 3 = 0 THEN {UNKNOWN} ELSE 'anti' || word END AS antonym,
    CASE WHEN size % 4 = 0 THEN {UNKNOWN} ELSE coalesce(
      lead(word) OVER (PARTITION BY batch_id ORDER BY word),
      first_value(word) OVER (PARTITION BY batch_id ORDER BY word)) END AS synonym,
    ['kata nama', 'kata kerja', 'kata sifat', 'kata hubung', 'bukan kategori'][size % 5 + 1] AS pos,
    CASE WHEN size % 13 = 0 THEN 'n/a' ELSE CAST(size * 37 % 201 - 100 AS VARCHAR) END AS sentiment
  FROM batched)"""


def _with(*parts: str, query: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join(parts)}\n{query}"


_LEXICON = (_WORDS, _LABELS)
_ANSWERS = (_WORDS, _answers("freq"))
_LABEL_COLUMNS = "batch_id, word, definition, antonym, synonym, pos, sentiment"

_MISSING = """
missing AS (SELECT word FROM nodes WHERE definition IS NULL AND pos IS NULL)"""

# Labels of the repair come after all others; a missing word is answered once.
_COUNTED = """
counted AS (
  SELECT word, pos, sentiment, 0 AS run, seq FROM valid
  UNION ALL
  SELECT word, pos, CAST(sentiment AS DOUBLE), 1, n FROM answered WHERE size % 11 <> 0 AND size % 13 <> 0)"""

_PAIRS = """
pairs AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE rel = 'SYNONYM')"""
_ANTONYM_PAIRS = _PAIRS.replace("SYNONYM", "ANTONYM")
# Words link inside blocks of eight only, so a component has at most 64 pairs.
_COMPONENTS = """
links AS (SELECT a AS u, b AS v FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(word, seen) AS (
  SELECT u, u FROM links
  UNION
  SELECT r.word, l.v FROM reach r JOIN links l ON l.u = r.seen),
components AS (SELECT word, min(seen) AS component FROM reach GROUP BY word)"""


# Every merge inside a component of eight words helps in a network of this size, so each component is one theme.
_SMALL_THEMES = """
SELECT dense_rank() OVER (ORDER BY n DESC, component) - 1 AS theme_id, component AS theme, word
FROM components JOIN (SELECT component, count(*) AS n FROM components GROUP BY component) USING (component)"""

_PLANTED = """
places AS (SELECT word, r // 10 AS q, r % 10 AS kind FROM (
  SELECT word, row_number() OVER (ORDER BY word) - 1 AS r FROM freq) WHERE r % 10 < 3),
sized AS (SELECT count(*) AS words, CAST(ceil(1.3 * pow(count(*), 1.0 / 3)) AS BIGINT) + 4 AS s FROM places WHERE kind = 0),
planted AS (
  SELECT word, kind, CASE kind WHEN 0 THEN q // s WHEN 1 THEN 0 ELSE q // (4 * s) END AS g FROM places, sized
  WHERE kind = 1 OR kind = 0 AND q < words // s * s OR kind = 2 AND q < words // (4 * s) * (4 * s))"""


_PLANTED_PAIRS = """
placed AS (SELECT p.kind, p.g, places.q FROM planted p JOIN places USING (word)),
planted_pairs AS (
  SELECT a.kind, a.g AS ga, b.g AS gb FROM placed a JOIN placed b ON a.kind = 0 AND b.kind = 0 AND a.g = b.g AND a.q < b.q
  UNION ALL
  SELECT 0, a.g, b.g FROM placed a JOIN placed b ON a.kind = 0 AND b.kind = 0 AND b.g = a.g + 1 AND b.q = a.q + 1
  UNION ALL
  SELECT 1, g, g FROM placed WHERE kind = 1 AND q > 0
  UNION ALL
  SELECT 2, a.g, b.g FROM placed a JOIN placed b ON a.kind = 2 AND b.kind = 2 AND a.g = b.g AND b.q = a.q + 1)"""


def _both_ways(rel: str) -> str:
    return f"""
linked AS (
  SELECT DISTINCT word, neighbour FROM (
    SELECT src AS word, dst AS neighbour FROM edges WHERE rel = '{rel}'
    UNION ALL SELECT dst, src FROM edges WHERE rel = '{rel}'))"""


def _parts(size: int) -> str:
    return f"""
SELECT word, part, string_agg(neighbour, ', ' ORDER BY neighbour) AS neighbours FROM (
  SELECT word, neighbour, (row_number() OVER (PARTITION BY word ORDER BY neighbour) - 1) // {size} AS part FROM linked)
GROUP BY word, part"""


_ASCII_WORDS = """
SELECT word FROM (
  SELECT unnest(string_split(regexp_replace(html, '[^a-zA-Z ]', '', 'g'), ' ')) AS word FROM pages)
WHERE word <> ''"""

_NAV = r"regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"
_NAV_LABELS = rf"regexp_extract_all({_NAV}, '<a href=\"[^\"]*\">([^<]*)</a>', 1)"
_TITLE_TAG = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"
_TITLE = _stripped(_decoded(_TITLE_TAG))

ORACLE = {
    "tokens": """
SELECT unnest(string_split(replace(concat_ws(' ', source, text), ', ', ' '), ' ')) AS word FROM documents""",
    "tokens_glued": """
SELECT unnest(string_split(replace(source || text, ', ', ' '), ' ')) AS word FROM documents""",
    "article_words": """
SELECT unnest(string_split(replace(concat_ws(' ', source, text), ', ', ' '), ' ')) AS word FROM documents WHERE n_chars > 0
UNION ALL
SELECT unnest(string_split(replace(text, ', ', ' '), ' ')) AS word FROM conversations""",
    "clean_words": _with(_WORDS, query="SELECT DISTINCT word FROM words"),
    "word_freq": _with(_WORDS, query="SELECT word, frequency FROM freq"),
    "word_freq_by_token": _with(_WORDS, query="SELECT word, frequency FROM freq"),
    "vocab_size": _with(_WORDS, query="""
SELECT count(DISTINCT word)::BIGINT AS words, count(*)::BIGINT AS occurrences FROM words"""),
    "top_words": _with(_WORDS, query="SELECT word, frequency FROM freq ORDER BY frequency DESC, word LIMIT 10"),
    "bottom_words": _with(_WORDS, query="SELECT word, frequency FROM freq ORDER BY frequency, word LIMIT 10"),
    "hapax_words": _with(_WORDS, query="SELECT word FROM freq WHERE frequency = 1"),
    "words_union": _with(_WORDS, _PAGE_TEXT, _PAGE_WORDS, query="""
SELECT word FROM words UNION ALL SELECT word FROM page_words"""),
    "merge_counts": _with(_WORDS, _PAGE_TEXT, _PAGE_WORDS, query="""
SELECT word, count(*)::BIGINT AS frequency FROM (SELECT word FROM words UNION ALL SELECT word FROM page_words)
GROUP BY word"""),
    "positive_views": """
SELECT event_id, views FROM (
  SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') || CASE WHEN event_id % 3 = 0 THEN '0000000000' ELSE '' END AS BIGINT) AS views
  FROM events WHERE event_type <> 'error')
WHERE views > 0""",
    "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "page_ids_range": """
WITH stored AS (SELECT CASE WHEN page_id % 2 = 0 THEN page_id ELSE page_id * 5000000000 END AS page_id FROM pages),
asked AS (SELECT unnest(range(100, 300)) AS page_id)
SELECT page_id, 'https://forum.example.com/view?aid=' || page_id AS url, a.page_id IS NOT NULL AS in_range,
  s.page_id IS NOT NULL AS is_stored, page_id AS aid
FROM asked a FULL JOIN stored s USING (page_id)""",
    "forum_fields": f"""
SELECT doc_id AS "AID", source || ' ' || lang AS "Title",
  CASE WHEN doc_id % 5 = 0 THEN 'Unknown' ELSE '2024-1-' || (doc_id % 28 + 1) END AS "Date",
  CASE WHEN doc_id % 5 = 0 THEN 'Unknown' ELSE source END AS "Publisher",
  CASE WHEN doc_id % 7 = 0 THEN 0 ELSE n_chars * 1000003 END AS "Views", doc_id % 4 AS "Comments_Count",
  CASE WHEN doc_id % 11 = 0 THEN '' ELSE {_stripped("text")} || lang END AS "Content"
FROM documents""",
    "forum_comments": """
SELECT doc_id AS "AID", CASE WHEN k % 2 = 1 THEN 0 ELSE doc_id * 10 + k + 3000000000 END AS "Comment_ID",
  CASE WHEN k = 2 THEN 'Anonymous' ELSE 'user' || k END AS "User",
  CASE WHEN k = 1 THEN 'No comment text' ELSE 'says é ' || k END AS "Comment_Text"
FROM (SELECT doc_id, unnest(range(0, doc_id % 4)) AS k FROM documents)""",
    "page_rejects": "SELECT page_id, 'no html' AS problem FROM pages WHERE page_id % 9 = 0",
    "page_fields": rf"""
SELECT page_id AS "AID", {_TITLE} AS "Title",
  {_stripped("split_part(array_to_string([" + _decoded("x") + " for x in labels], ''), '|', 1)")} AS "Date",
  {_stripped(_decoded("labels[1]"))} AS "Publisher", CAST(0 AS BIGINT) AS "Views", CAST(0 AS BIGINT) AS "Comments_Count",
  array_to_string([{_stripped(_decoded("x"))} for x in texts], '') AS "Content"
FROM (
  SELECT page_id, html, {_NAV_LABELS} AS labels,
    string_split_regex(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<[^>]*>') AS texts
  FROM pages)""",
    "page_comments": rf"""
SELECT "AID", CAST(0 AS BIGINT) AS "Comment_ID", label AS "User", label AS "Comment_Text" FROM (
  SELECT "AID", {_stripped(_decoded("label"))} AS label FROM (
    SELECT page_id AS "AID", unnest({_NAV_LABELS}) AS label FROM pages))""",
    "page_titles": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "page_text": _with(_PAGE_TEXT, query="SELECT page_id, text FROM page_text"),
    "page_links": rf"""
SELECT page_id, CAST(position - 1 AS INTEGER) AS position, {_decoded("hrefs[position]")} AS href,
  {_stripped(_decoded("labels[position]"))} AS label
FROM (
  SELECT page_id, hrefs, labels, unnest(range(1, len(hrefs) + 1)) AS position FROM (
    SELECT page_id, regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS hrefs,
      regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS labels FROM pages))""",
    "api_search_titles": f"""
SELECT response_id, CAST(n - 1 AS INTEGER) AS position, title FROM (
  SELECT page_id // 120 AS response_id, {_TITLE} AS title,
    row_number() OVER (PARTITION BY page_id // 120 ORDER BY page_id) AS n FROM pages)""",
    "api_page_extracts": """SELECT url AS "Title", html AS "Content" FROM pages WHERE page_id % 5 <> 0""",
    "pages_to_messages": """SELECT url AS "Title", html AS "Content" FROM pages""",
    "stream_words": _ASCII_WORDS,
    "stream_csv_words": _ASCII_WORDS,
    "stream_word_freq": f"SELECT word, count(*)::BIGINT AS frequency FROM ({_ASCII_WORDS}) GROUP BY word",
    "numbered_words": _with(_WORDS, query="SELECT word, row_number() OVER (ORDER BY word) AS row_number FROM freq"),
    "label_batches": _with(*_ANSWERS, query="SELECT batch_id, word FROM batched"),
    "label_prompts": _with(*_ANSWERS, query="""
SELECT batch_id, 'Words: ' || string_agg(word, ', ' ORDER BY word) AS prompt FROM batched GROUP BY batch_id"""),
    "label_rows": _with(*_ANSWERS, query=f"SELECT {_LABEL_COLUMNS} FROM answered WHERE size % 11 <> 0"),
    "label_rows_strict": _with(*_ANSWERS, query=f"""
SELECT {_LABEL_COLUMNS} FROM answered
WHERE CASE WHEN size % 11 = 0 THEN contains(definition, ',') ELSE NOT contains(definition, ',') END"""),
    "label_rejects": _with(*_ANSWERS, query="""
SELECT batch_id,
  '"' || word || '","' || definition || '","' || antonym || '","' || synonym || '","' || pos || '"' ||
    CASE WHEN size % 11 = 0 THEN '' ELSE ',"' || sentiment || '"' END AS line,
  CASE WHEN size % 11 = 0 THEN 'field_count' ELSE 'sentiment' END AS reason
FROM answered WHERE size % 11 = 0 OR size % 13 = 0"""),
    "usable_words": _with(*_ANSWERS, query=f"""
SELECT {_LABEL_COLUMNS} FROM answered
WHERE size % 11 <> 0 AND (
  NOT (contains(lower(definition), {UNKNOWN}) OR contains(lower(definition), 'nama'))
  OR NOT (contains(lower(antonym), {UNKNOWN}) OR contains(lower(antonym), 'nama'))
  OR NOT (contains(lower(synonym), {UNKNOWN}) OR contains(lower(synonym), 'nama')))"""),
    "valid_labels": _with(*_LEXICON, query="SELECT seq, word, definition, antonym, synonym, pos, sentiment FROM valid"),
    "lexicon_nodes": _with(*_LEXICON, _NODES, query="SELECT word, definition, pos FROM nodes"),
    "lexicon_nodes_keep": _with(*_LEXICON, _nodes("step, seq DESC"), query="SELECT word, definition, pos FROM nodes"),
    "lexicon_edges": _with(*_LEXICON, _EDGES, query="SELECT src, rel, dst FROM edges"),
    "lexicon_coverage": _with(*_LEXICON, _NODES, query="""
SELECT count(DISTINCT word)::BIGINT AS unique_entries FROM nodes"""),
    "pos_counts": _with(*_LEXICON, query=f"""
SELECT CASE WHEN pos = 'bukan kategori' THEN {UNKNOWN} ELSE pos END AS pos, count(*)::BIGINT AS n FROM valid
GROUP BY 1"""),
    "sentiment_counts": _with(*_LEXICON, query="""
SELECT CASE WHEN sentiment > 0 THEN 'positive' WHEN sentiment < 0 THEN 'negative' ELSE 'neutral' END AS bucket,
  count(*)::BIGINT AS n
FROM valid GROUP BY 1"""),
    "word_sentiment": _with(*_LEXICON, _SENTIMENT, query="SELECT word, sentiment FROM word_sentiment"),
    "lookup_words": _with(*_LEXICON, _NODES, _BENCHMARK, query="""
SELECT n.word, n.definition, n.pos FROM keys k JOIN nodes n ON n.word = k.word"""),
    "neighbours_out": _with(*_LEXICON, _EDGES, _BENCHMARK, query="""
SELECT DISTINCT k.word, e.dst AS neighbour FROM keys k JOIN edges e ON e.src = k.word AND e.rel = 'SYNONYM'"""),
    "word_profile": _with(*_LEXICON, _NODES, _EDGES, _SENTIMENT, """
wanted AS (SELECT word FROM freq UNION SELECT word FROM nodes),
listed AS (
  SELECT src AS word, string_agg(dst, ', ' ORDER BY dst) FILTER (WHERE rel = 'SYNONYM') AS synonyms,
    string_agg(dst, ', ' ORDER BY dst) FILTER (WHERE rel = 'ANTONYM') AS antonyms
  FROM edges GROUP BY src)""", query="""
SELECT w.word, CAST(0 AS BIGINT) AS part, coalesce(f.frequency, 0) AS frequency, s.sentiment,
  coalesce(l.synonyms, '') AS synonyms, coalesce(l.antonyms, '') AS antonyms
FROM wanted w LEFT JOIN freq f ON f.word = w.word LEFT JOIN word_sentiment s ON s.word = w.word
LEFT JOIN listed l ON l.word = w.word"""),
    "neighbour_sets": _with(*_LEXICON, _EDGES, _both_ways("SYNONYM"), query=_parts(1000)),
    "neighbour_parts": _with(*_LEXICON, _EDGES, _both_ways("ANTONYM"), query=_parts(2)),
    "network_edges": _with(*_LEXICON, _EDGES, _PAIRS, query="SELECT a, b FROM pairs"),
    "network_first_words": _with(*_LEXICON, _EDGES, _both_ways("ANTONYM"), query="""
SELECT DISTINCT least(word, neighbour) AS a, greatest(word, neighbour) AS b FROM linked
WHERE word IN (SELECT DISTINCT word FROM linked ORDER BY word LIMIT 20)"""),
    "components": _with(*_LEXICON, _EDGES, _PAIRS, _COMPONENTS, recursive=True, query="""
SELECT word, component FROM components"""),
    "modularity": _with(*_LEXICON, _EDGES, _PAIRS, _COMPONENTS, recursive=True, query="""
SELECT round(sum(l / m - (l / m) * (l / m)), 9) AS modularity FROM (
  SELECT CAST(count(*) AS DOUBLE) AS l, CAST((SELECT count(*) FROM pairs) AS DOUBLE) AS m
  FROM pairs p JOIN components c ON c.word = p.a GROUP BY c.component)"""),
    "themes": _with(*_LEXICON, _EDGES, _PAIRS, _COMPONENTS, recursive=True, query=_SMALL_THEMES),
    "antonym_components": _with(*_LEXICON, _EDGES, _ANTONYM_PAIRS, _COMPONENTS, recursive=True, query="""
SELECT word, component FROM components"""),
    "antonym_themes": _with(*_LEXICON, _EDGES, _ANTONYM_PAIRS, _COMPONENTS, recursive=True, query=_SMALL_THEMES),
    "planted_components": _with(_WORDS, _PLANTED, query="""
SELECT word, min(word) OVER (PARTITION BY kind, CASE WHEN kind = 2 THEN g END) AS component FROM planted"""),
    "planted_themes": _with(_WORDS, _PLANTED, query="""
SELECT dense_rank() OVER (ORDER BY n DESC, theme) - 1 AS theme_id, theme, word FROM (
  SELECT word, min(word) OVER (PARTITION BY kind, g) AS theme, count(*) OVER (PARTITION BY kind, g) AS n FROM planted)"""),
    "words_missing_props": _with(*_LEXICON, _NODES, query="""
SELECT word FROM nodes WHERE definition IS NULL AND pos IS NULL"""),
    "repair_lexicon": _with(*_LEXICON, _NODES, _MISSING, _answers("missing"), query="""
SELECT n.word, CASE WHEN a.word IS NULL THEN n.definition ELSE a.definition END AS definition,
  CASE WHEN a.word IS NULL THEN n.pos ELSE a.pos END AS pos
FROM nodes n LEFT JOIN answered a ON a.word = n.word AND a.size % 11 <> 0 AND a.size % 13 <> 0"""),
    "repair_counts": _with(*_LEXICON, _NODES, _MISSING, _answers("missing"), query=f"""
SELECT CASE WHEN pos = 'bukan kategori' THEN {UNKNOWN} ELSE pos END AS pos, count(*)::BIGINT AS n FROM answered
WHERE size % 11 <> 0 AND size % 13 <> 0 GROUP BY 1"""),
    "repair_pos_counts": _with(*_LEXICON, _NODES, _MISSING, _answers("missing"), _COUNTED, query=f"""
SELECT CASE WHEN pos = 'bukan kategori' THEN {UNKNOWN} ELSE pos END AS pos, count(*)::BIGINT AS n FROM counted GROUP BY 1"""),
    "repair_sentiment_counts": _with(*_LEXICON, _NODES, _MISSING, _answers("missing"), _COUNTED, query="""
SELECT CASE WHEN sentiment > 0 THEN 'positive' WHEN sentiment < 0 THEN 'negative' ELSE 'neutral' END AS bucket,
  count(*)::BIGINT AS n
FROM counted GROUP BY 1"""),
    "repair_word_sentiment": _with(*_LEXICON, _NODES, _MISSING, _answers("missing"), _COUNTED, query="""
SELECT word, sentiment FROM (
  SELECT word, sentiment, row_number() OVER (PARTITION BY word ORDER BY run DESC, seq DESC) AS n FROM counted)
WHERE n = 1"""),
    "lexicon_nodes_two_runs": _with(*_LEXICON, *_TWO_RUNS, query="SELECT word, definition, pos FROM nodes"),
    "lexicon_edges_two_runs": _with(*_LEXICON, *_TWO_RUNS, query="SELECT src, rel, dst FROM edges"),
    "word_sentiment_two_runs": _with(*_LEXICON, _USABLE, query=f"""
SELECT word, sentiment FROM (
  SELECT word, sentiment, row_number() OVER (PARTITION BY word ORDER BY {_SECOND_RUN}) AS n FROM usable)
WHERE n = 1"""),
    "coverage_two_runs": _with(*_LEXICON, *_TWO_RUNS, query="SELECT count(*)::BIGINT AS exact, true AS within FROM nodes"),
    "lookup_words_stored": _with(*_LEXICON, *_TWO_RUNS, _BENCHMARK, query="""
SELECT n.word, n.definition, n.pos FROM keys k JOIN nodes n ON n.word = k.word"""),
    "neighbours_out_stored": _with(*_LEXICON, *_TWO_RUNS, _BENCHMARK, query="""
SELECT DISTINCT k.word, e.dst AS neighbour FROM keys k JOIN edges e ON e.src = k.word AND e.rel = 'SYNONYM'"""),
    "components_two_runs": _with(*_LEXICON, *_TWO_RUNS, _PAIRS, _COMPONENTS, recursive=True, query="""
SELECT word, component FROM components"""),
    "themes_modularity": _with(_WORDS, _PLANTED, _PLANTED_PAIRS, query="""
SELECT round(sum(l / m - (d / (2 * m)) * (d / (2 * m))), 9) AS modularity FROM (
  SELECT sum(CASE WHEN inner_edge THEN 0.5 ELSE 0 END)::DOUBLE AS l, count(*)::DOUBLE AS d,
    (SELECT count(*) FROM planted_pairs)::DOUBLE AS m
  FROM (
    SELECT kind, ga AS g, ga = gb AS inner_edge FROM planted_pairs UNION ALL SELECT kind, gb, ga = gb FROM planted_pairs)
  GROUP BY kind, g)"""),
}
