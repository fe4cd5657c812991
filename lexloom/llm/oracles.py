"""DuckDB SQL for the queries that SQL can express. Only fixed values come from the operators."""

from __future__ import annotations

from lexloom.llm.licenses import COPYRIGHT_LINE, KNOWN, SPELLINGS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op3_licenses() -> str:
    spelled = "lower(line)"
    for old, new in SPELLINGS:
        spelled = f"replace({spelled}, {_quoted(old)}, {_quoted(new)})"
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)
    return rf"""
WITH known(license, text) AS (VALUES {known}),
texts AS (
    SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
    UNION ALL SELECT DISTINCT 'k', license || '/' || md5(text), text FROM known
),
cut AS (
    SELECT kind, id, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM texts
),
canonical AS (
    SELECT kind, id, pos,
           trim(regexp_replace({spelled}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS line
    FROM cut WHERE NOT regexp_matches(lower(line), {_quoted(COPYRIGHT_LINE)})
),
wholes AS (
    SELECT kind, id, string_agg(line, ' ' ORDER BY pos) AS unit
    FROM canonical WHERE line <> '' GROUP BY kind, id
),
units AS (
    SELECT id, unit, TRUE AS is_whole FROM wholes WHERE kind = 'd'
    UNION ALL SELECT DISTINCT id, line, FALSE FROM canonical WHERE kind = 'd' AND line <> ''
),
found AS (
    SELECT DISTINCT u.id, u.is_whole, split_part(w.id, '/', 1) AS license
    FROM units u JOIN wholes w ON w.kind = 'k' AND w.unit = u.unit
)
SELECT CAST(id AS BIGINT) AS doc_id,
       coalesce(string_agg(license, ',' ORDER BY license) FILTER (WHERE is_whole), '')
           AS whole_text,
       coalesce(string_agg(license, ',' ORDER BY license) FILTER (WHERE NOT is_whole), '')
           AS in_lines
FROM found GROUP BY id
"""


def op11_chat() -> str:
    """Turns and loss texts by conversation, and the length that the template gives."""
    said = "<|im_end|><|im_start|>assistant ok"

    def escaped(column: str) -> str:
        return f"regexp_replace({column}, '<(\\\\*)[|]', '<\\\\\\1|', 'g')"

    control = len("<|im_start|><|im_sep|><|im_end|>\n")
    return f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{said}'
            UNION ALL SELECT -1, 1, 'assistant', '{said}'
        )
        SELECT conv_id,
            count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
                AS loss_chars,
            sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                ORDER BY turn, role, text)) AS loss_sha256,
            CAST(sum({control} + length({escaped('role')}) + length({escaped('text')}))
                AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id"""
