"""The same results as plain SQL over the given tables, written from the definitions."""

from __future__ import annotations

from peopleflow import domains as d
from peopleflow.plans import catalogue as c
from peopleflow.plans.inputs import EVENT_TYPES
from peopleflow.sinks.sql_dump import PEOPLE_SQL_TYPES, ROWS_PER_INSERT, create_table_text


def _rounded_average(column: str, digits: int) -> str:
    """Average rounded half up in decimal, as Spark rounds: from the shortest text of the double."""
    return f"round(avg({column})::VARCHAR::DECIMAL(38, 15), {digits})::DOUBLE"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _draw(text: str, slot: int) -> str:
    return f"('0x' || substr({text}, {8 * slot + 1}, 8))::BIGINT"


def _people(ids: str, name: str = "p") -> str:
    """CTEs that generate one person per id of a query with a column ``id``."""
    ages = d.MAX_AGE - d.MIN_AGE + 1
    cents = d.MAX_INCOME_CENTS - d.MIN_INCOME_CENTS + 1
    return f"""
    {name}_digests AS (
        SELECT id, md5('42|0|' || id) AS a, md5('42|1|' || id) AS b, md5('42|2|' || id) AS c
        FROM ({ids})
    ), {name}_draws AS (
        SELECT id, {_draw("a", 0)} AS gen, {_draw("a", 1)} AS nom, {_draw("a", 2)} AS ape,
               {_draw("a", 3)} AS ciu, {_draw("b", 0)} AS ocu, {_draw("b", 1)} AS niv,
               {_draw("b", 2)} AS eda, {_draw("b", 3)} AS ing, {_draw("c", 0)} AS act,
               {_draw("c", 1)} AS fec
        FROM {name}_digests
    ), {name} AS (
        SELECT id::BIGINT AS id_persona,
               CASE WHEN gen % 2 = 1 THEN {_list(d.FEMALE_NAMES)}[nom % {len(d.FEMALE_NAMES)} + 1]
                    ELSE {_list(d.MALE_NAMES)}[nom % {len(d.MALE_NAMES)} + 1] END AS nombre,
               {_list(d.SURNAMES)}[ape % {len(d.SURNAMES)} + 1] AS apellido,
               ({d.MIN_AGE} + eda % {ages})::INT AS edad,
               {_list(d.GENDERS)}[gen % 2 + 1] AS genero,
               {_list([x for x, _ in d.CITIES])}[ciu % {len(d.CITIES)} + 1] AS ciudad,
               {_list([y for _, y in d.CITIES])}[ciu % {len(d.CITIES)} + 1] AS estado,
               {_list(d.OCCUPATIONS)}[ocu % {len(d.OCCUPATIONS)} + 1] AS ocupacion,
               {_list(d.EDUCATION)}[niv % {len(d.EDUCATION)} + 1] AS nivel_estudios,
               ({d.MIN_INCOME_CENTS} + ing % {cents}) / 100 AS ingreso_mensual,
               act % 2 = 0 AS activo,
               (DATE '{d.FIRST_DAY}' + (fec % {d.DAYS})::INT)::DATE AS fecha_registro
        FROM {name}_draws
    )"""


CUSTOMERS = "SELECT c_custkey + 1 AS id FROM customer"
SUPPLIERS = "SELECT -s_suppkey - 1 AS id FROM supplier"


def _over_people(query: str) -> str:
    return f"WITH {_people(CUSTOMERS)} {query}"


PEOPLE = _over_people("SELECT * FROM p")

# The customer's last order in the order of the topic log.
LAST_ORDER = """
    SELECT o_custkey + 1 AS id,
           arg_max(struct_pack(status := o_orderstatus, price := o_totalprice,
                               day := o_orderdate::DATE),
                   (o_orderdate, o_orderkey % 3, o_orderkey // 3)) AS last
    FROM orders GROUP BY o_custkey
"""


def _last_values(income: str) -> str:
    return _over_people(f"""
    , o AS ({LAST_ORDER})
    SELECT id_persona, nombre, apellido, edad, genero, ciudad, estado, ocupacion, nivel_estudios,
           {income} AS ingreso_mensual,
           CASE WHEN o.id IS NULL THEN activo ELSE o.last.status <> 'F' END AS activo,
           CASE WHEN o.id IS NULL THEN fecha_registro ELSE o.last.day END AS fecha_registro
    FROM p LEFT JOIN o ON o.id = p.id_persona""")


MERGED = _last_values("""CASE WHEN o.id IS NULL THEN ingreso_mensual
                WHEN o.last.status = 'P' THEN NULL ELSE o.last.price END""")
JOINED = _last_values("ingreso_mensual")

PERSON_JSON = """'{"id_persona":' || id_persona || ',"nombre":"' || nombre || '","apellido":"'
    || apellido || '","edad":' || edad || ',"genero":"' || genero || '","ciudad":"' || ciudad
    || '","estado":"' || estado || '"}'"""
JOB_JSON = """'{"id_persona":' || id_persona || ',"ocupacion":"' || ocupacion
    || '","nivel_estudios":"' || nivel_estudios || '","ingreso_mensual":' || ingreso_mensual
    || '}'"""
ACTIVITY_JSON = """'{"id_persona":' || id_persona || ',"activo":' || activo
    || ',"fecha_registro":"' || fecha_registro || '"}'"""

FANOUT = _over_people(f"""
    SELECT id_persona, 'personas' AS topic, {PERSON_JSON} AS value FROM p
    UNION ALL SELECT id_persona, 'empleos', {JOB_JSON} FROM p
    UNION ALL SELECT id_persona, 'actividad', {ACTIVITY_JSON} FROM p""")

PERSON_LINE = """'id=' || format('{:<6}', id_persona::VARCHAR) || ' | ' || nombre || ' '
    || format('{:<12}', apellido) || ' | ' || edad || ' años | ' || ciudad || ', ' || estado"""
JOB_LINE = """'id=' || format('{:<6}', id_persona::VARCHAR) || ' | '
    || format('{:<14}', ocupacion) || ' | ' || format('{:<12}', nivel_estudios) || ' | $'
    || format('{:,.2f}', ingreso_mensual)"""
ACTIVITY_LINE = """'id=' || format('{:<6}', id_persona::VARCHAR) || ' | '
    || CASE WHEN activo THEN '✔ Activo  ' ELSE '✘ Inactivo' END || ' | Registro: '
    || fecha_registro"""


def _three_lines(source: str, topics: tuple[str, ...], key: str = "id_persona") -> str:
    lines = {"personas": PERSON_LINE, "empleos": JOB_LINE, "actividad": ACTIVITY_LINE}
    return " UNION ALL ".join(
        f"SELECT {key} AS seq, '{topic}' AS topic, {lines[topic]} AS body FROM {source}"
        for topic in topics
    )


def _framed(rows: str) -> str:
    return f"""SELECT topic, (seq % 3)::INT AS "partition", (seq // 3)::BIGINT AS "offset",
        '[' || format('{{:<9}}', topic) || '] p' || (seq % 3) || '/o'
        || format('{{:<6}}', (seq // 3)::VARCHAR) || ' ' || body AS line
    FROM ({rows})"""


MONITOR = f"""WITH {_people(CUSTOMERS)}, {_people(SUPPLIERS, "s")}
    {_framed(f'''
        {_three_lines("p", ("personas", "empleos", "actividad"))}
        UNION ALL {_three_lines("s", ("personas", "empleos"), "-id_persona")}
        UNION ALL SELECT o_orderkey, 'actividad', 'id=' || format('{{:<6}}', (o_custkey + 1)::VARCHAR)
            || ' | ' || CASE WHEN o_orderstatus <> 'F' THEN '✔ Activo  ' ELSE '✘ Inactivo' END
            || ' | Registro: ' || o_orderdate::DATE FROM orders
        UNION ALL SELECT o_orderkey, 'empleos', 'id=' || format('{{:<6}}', (o_custkey + 1)::VARCHAR)
            || ' | ' || repeat(' ', 14) || ' | ' || repeat(' ', 12) || ' | $'
            || format('{{:,.2f}}', CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END)
            FROM orders
        UNION ALL SELECT p_partkey, 'personas', p_name FROM part''')}"""

MONITOR_FIRST = _over_people(f"""
    {_framed(_three_lines("p", ("personas", "empleos", "actividad")))}
    ORDER BY (seq, topic) LIMIT 50""")

RAW_FIRST = _over_people(f"""
    SELECT topic, (id_persona % 3)::INT AS "partition", (id_persona // 3)::BIGINT AS "offset",
           '[' || format('{{:>10}}', topic) || '] ' || value AS line
    FROM (SELECT id_persona, 'personas' AS topic, {PERSON_JSON} AS value FROM p
          UNION ALL SELECT id_persona, 'empleos', {JOB_JSON} FROM p
          UNION ALL SELECT id_persona, 'actividad', {ACTIVITY_JSON} FROM p)
    ORDER BY id_persona, topic LIMIT 30""")


def _word_rows(source: str, columns: list[str]) -> str:
    text = f"lower(concat_ws(' ', {', '.join(columns)}))"
    return f"""SELECT word FROM (
        SELECT unnest(regexp_split_to_array({text}, '\\s+')) AS word FROM {source})
    WHERE word <> ''"""


def _word_count(source: str, columns: list[str]) -> str:
    return f"SELECT word, count(*) AS n FROM ({_word_rows(source, columns)}) GROUP BY word"


DOCUMENT_WORDS = _word_count("documents", c.DOCUMENT_TEXT)
PEOPLE_WORDS = ["nombre", "apellido", "ciudad", "estado", "ocupacion", "nivel_estudios"]

SQL_VALUES = """id_persona || ', ''' || nombre || ''', ''' || apellido || ''', ' || edad || ', '''
    || genero || ''', ''' || ciudad || ''', ''' || estado || ''', ''' || ocupacion || ''', '''
    || nivel_estudios || ''', ' || ingreso_mensual || ', ' || upper(activo::VARCHAR) || ', '''
    || fecha_registro || ''''"""

PART_VALUES = """p_partkey || ', ''' || replace(p_name, '''', '''''') || ''', '''
    || replace(p_brand, '''', '''''') || ''', ''' || replace(p_type, '''', '''''') || ''', '
    || p_size || ', ' || p_retailprice"""

SQL_BATCHES = _over_people(f"""
    , lines AS (
        SELECT (row_number() OVER (ORDER BY id_persona) - 1) // {ROWS_PER_INSERT} + 1 AS batch,
               id_persona, '    (' || {SQL_VALUES} || ')' AS line
        FROM p
    )
    SELECT 0::BIGINT AS batch, 0::BIGINT AS n_rows,
           '{create_table_text("personas", PEOPLE_SQL_TYPES)}' AS statement
    UNION ALL
    SELECT batch::BIGINT, count(*)::BIGINT,
           'INSERT INTO personas ({", ".join(PEOPLE_SQL_TYPES)}) VALUES' || chr(10)
           || string_agg(line, ',' || chr(10) ORDER BY id_persona) || ';' || chr(10)
    FROM lines GROUP BY batch""")

EVENT_AT = "(ts, event_id)"


def _merged_events(upto: str = "TRUE") -> str:
    values = ", ".join(
        f"arg_max(value, {EVENT_AT}) FILTER (event_type = '{kind}') AS {kind}"
        for kind in EVENT_TYPES
    )
    return f"""SELECT user_id, {values} FROM events WHERE {upto}
        GROUP BY user_id HAVING count(DISTINCT event_type) = {len(EVENT_TYPES)}"""


COMPLETIONS = f"""
    SELECT user_id, max(first).ts AS ts, max(first).event_id AS event_id
    FROM (SELECT user_id, event_type,
                 min(struct_pack(ts := ts, event_id := event_id)) AS first
          FROM events GROUP BY user_id, event_type)
    GROUP BY user_id HAVING count(*) = {len(EVENT_TYPES)}"""

FIRST_N_EVENTS = f"""
    WITH done AS ({COMPLETIONS}),
    cut AS (SELECT ts, event_id FROM done ORDER BY ts, event_id
            LIMIT 1 OFFSET {c.FIRST_N_USERS - 1})
    {_merged_events("NOT EXISTS (FROM cut) OR (ts, event_id) <= (SELECT (ts, event_id) FROM cut)")}"""

_SCHEMA_ROWS = {
    "json": [
        ("activo", "boolean"), ("apellido", "string"), ("ciudad", "string"), ("edad", "bigint"),
        ("estado", "string"), ("fecha_registro", "string"), ("genero", "string"),
        ("id_persona", "bigint"), ("ingreso_mensual", "double"), ("nivel_estudios", "string"),
        ("nombre", "string"), ("ocupacion", "string"),
    ],
    "csv": [
        ("id_persona", "int"), ("nombre", "string"), ("apellido", "string"), ("edad", "int"),
        ("genero", "string"), ("ciudad", "string"), ("estado", "string"),
        ("ocupacion", "string"), ("nivel_estudios", "string"), ("ingreso_mensual", "double"),
        ("activo", "boolean"), ("fecha_registro", "date"),
    ],
}
SCHEMAS = " UNION ALL ".join(
    f"SELECT '{kind}' AS format, {i}::INT AS position, '{name}' AS \"column\", '{dtype}' AS type"
    for kind, rows in _SCHEMA_ROWS.items()
    for i, (name, dtype) in enumerate(rows, 1)
)

PROGRESS = f"""
    WITH sent AS (SELECT c_custkey + 1 AS seq, 3 AS n, 1 AS good, 0 AS bad FROM customer
                  UNION ALL SELECT p_partkey, 1, 0, 1 FROM part)
    SELECT (seq // 3 % {c.PROGRESS_RUNS})::BIGINT AS batch_id, sum(n)::BIGINT AS input_rows,
           count(*)::BIGINT AS personas, sum(good)::BIGINT AS empleos,
           sum(good)::BIGINT AS actividad, sum(bad)::BIGINT AS malformed
    FROM sent GROUP BY 1"""

# The last offset of each partition, from the sequence numbers that make partition and offset.
_SEQUENCES = """
    SELECT 'personas' AS topic, c_custkey + 1 AS seq FROM customer
    UNION ALL SELECT 'empleos', c_custkey + 1 FROM customer
    UNION ALL SELECT 'actividad', c_custkey + 1 FROM customer
    UNION ALL SELECT 'actividad', o_orderkey FROM orders
    UNION ALL SELECT 'personas', s_suppkey + 1 FROM supplier
    UNION ALL SELECT 'empleos', s_suppkey + 1 FROM supplier"""
LOG_ENDS = f"""
    SELECT topic, (seq % 3)::INT AS "partition", max(seq // 3)::BIGINT AS last, count(*) AS messages
    FROM ({_SEQUENCES} UNION ALL SELECT 'empleos', o_orderkey FROM orders
          UNION ALL SELECT 'personas', p_partkey FROM part)
    GROUP BY topic, seq % 3"""

MERGED_PINNED = _over_people(f"""
    , ends AS (SELECT seq % 3 AS part, max(seq // 3) AS last FROM ({_SEQUENCES})
               WHERE topic = 'empleos' GROUP BY 1),
    o AS ({LAST_ORDER}),
    paid AS (SELECT o_custkey + 1 AS id,
                    arg_max(struct_pack(status := o_orderstatus, price := o_totalprice),
                            (o_orderdate, o_orderkey % 3, o_orderkey // 3)) AS last
             FROM orders JOIN ends ON part = o_orderkey % 3 AND o_orderkey // 3 <= ends.last
             GROUP BY o_custkey)
    SELECT id_persona, nombre, apellido, edad, genero, ciudad, estado, ocupacion, nivel_estudios,
           CASE WHEN paid.id IS NULL THEN ingreso_mensual
                WHEN paid.last.status = 'P' THEN NULL ELSE paid.last.price END AS ingreso_mensual,
           CASE WHEN o.id IS NULL THEN activo ELSE o.last.status <> 'F' END AS activo,
           CASE WHEN o.id IS NULL THEN fecha_registro ELSE o.last.day END AS fecha_registro
    FROM p LEFT JOIN o ON o.id = p.id_persona LEFT JOIN paid ON paid.id = p.id_persona""")

VALIDITY = """
    WITH sizes AS (SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM orders) AS o,
                          (SELECT count(*) FROM supplier) AS s, (SELECT count(*) FROM part) AS p,
                          (SELECT count(*) FROM part WHERE p_partkey % 4 IN (0, 3)) AS bad,
                          (SELECT count(*) FROM part WHERE p_partkey % 4 = 2) AS bare)
    SELECT 'personas' AS topic, c + s + p AS messages, p AS malformed, 0 AS without_key,
           c + s AS merged FROM sizes
    UNION ALL SELECT 'empleos', c + s + o, 0, 0, c + s + o FROM sizes
    UNION ALL SELECT 'actividad', c + o + p, bad, bare, c + o + p - bad - bare FROM sizes"""

MERGED_ODD = _over_people("""
    SELECT id_persona, nombre, apellido, edad, genero, ciudad, estado, ocupacion, nivel_estudios,
           ingreso_mensual, p_partkey IS NOT NULL OR activo AS activo,
           CASE WHEN p_partkey IS NULL THEN fecha_registro ELSE DATE '2020-01-01' END AS fecha_registro
    FROM p LEFT JOIN part ON p_partkey + 1 = id_persona AND p_partkey % 4 = 1""")

_BYTES = "SELECT '{kind}' AS format, sum(strlen({line}) + 1)::BIGINT AS bytes FROM {source}"
_PERSON_TEXT = """'{"id_persona":' || id_persona || ',"nombre":"' || nombre || '","apellido":"' || apellido
    || '","edad":' || edad || ',"genero":"' || genero || '","ciudad":"' || ciudad || '","estado":"' || estado
    || '","ocupacion":"' || ocupacion || '","nivel_estudios":"' || nivel_estudios || '","ingreso_mensual":'
    || ingreso_mensual || ',"activo":' || activo || ',"fecha_registro":"' || fecha_registro || '"}'"""
_PERSON_CSV = " || ',' || ".join(
    "id_persona nombre apellido edad genero ciudad estado ocupacion nivel_estudios ingreso_mensual activo fecha_registro".split()
)
EXPORT_BYTES = f"""
    {_over_people(_BYTES.format(kind="json", line=_PERSON_TEXT, source="p"))}
    UNION ALL ({_over_people(_BYTES.format(kind="csv", line=_PERSON_CSV, source="p"))})
    UNION ALL ({_BYTES.format(kind="sql", line="statement", source=f"({SQL_BATCHES})")})"""
_PART_TEXT = """'{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_brand":"' || p_brand
    || '","p_type":"' || p_type || '","p_size":' || p_size || ',"p_retailprice":' || p_retailprice || '}'"""
_PART_CSV = "p_partkey || ',' || p_name || ',' || p_brand || ',' || p_type || ',' || p_size || ',' || p_retailprice"
RENDERED_BYTES = f"""
    {_BYTES.format(kind="json", line=_PART_TEXT, source="part")}
    UNION ALL {_BYTES.format(kind="csv", line=_PART_CSV, source="part")}"""

ORACLES: dict[str, str] = {
    "export_size_report": EXPORT_BYTES,
    "rendered_size_report": RENDERED_BYTES,
    "first_n_resumed": f"{PEOPLE} ORDER BY id_persona LIMIT {c.FIRST_N_PEOPLE}",
    "log_ends": LOG_ENDS,
    "merge_pinned": MERGED_PINNED,
    "message_validity": VALIDITY,
    "merge_odd_messages": MERGED_ODD,
    "stream_progress": PROGRESS,
    "scan_json_roundtrip": PEOPLE,
    "scan_csv_roundtrip": PEOPLE,
    "scan_csv_documents": "SELECT * FROM documents",
    "schema_report": SCHEMAS,
    "preview_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "scan_json_parts": "SELECT * FROM part",
    "consume_export": MERGED,
    "sql_literal_rows": _over_people(f"SELECT id_persona, {SQL_VALUES} AS sql_values FROM p"),
    "sql_literal_parts": f"SELECT p_partkey, {PART_VALUES} AS sql_values FROM part",
    "sql_export_batches": SQL_BATCHES,
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "filter_counts": _over_people("""
        SELECT count(*) FILTER (activo) AS active, count(*) FILTER (edad >= 30) AS aged_30_up,
               count(*) FILTER (ingreso_mensual > 50000) AS above_50k
        FROM p"""),
    "filter_counts_orders": """
        SELECT count(*) FILTER (o_orderstatus = 'O') AS open,
               count(*) FILTER (o_totalprice >= 100000) AS large,
               count(*) FILTER (o_orderstatus = 'P' AND o_totalprice > 200000) AS pending_large
        FROM orders""",
    "filtered_top_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
        WHERE o_orderstatus IN ('O', 'P') AND o_totalprice > 1000
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "top_customers": """
        SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey
        ORDER BY n DESC, o_custkey LIMIT 10""",
    "group_report_lineitem": f"""
        SELECT l_returnflag, l_linestatus, count(*) AS n,
               {_rounded_average("l_extendedprice", 2)} AS avg_l_extendedprice
        FROM lineitem WHERE l_quantity > 25
        GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus""",
    "group_cardinalities_orders": """
        SELECT (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders))
                   AS customer_status,
               (SELECT count(*) FROM (SELECT DISTINCT o_orderstatus FROM orders)) AS status""",
    "word_count": DOCUMENT_WORDS,
    "word_count_conversations": _word_count("conversations", ["role", "text"]),
    "word_count_people": _over_people(_word_count("p", PEOPLE_WORDS)),
    "word_count_top": f"{DOCUMENT_WORDS} ORDER BY n DESC, word LIMIT 20",
    "distinct_words": f"SELECT count(*) AS distinct_words FROM ({DOCUMENT_WORDS})",
    "count_by_key_topk": _over_people("""
        SELECT estado, count(*) AS n FROM p GROUP BY estado ORDER BY n DESC, estado LIMIT 10"""),
    "avg_by_key": f"""
        SELECT c_mktsegment, {_rounded_average("c_acctbal", 2)} AS avg_c_acctbal, count(*) AS n
        FROM customer GROUP BY c_mktsegment ORDER BY avg_c_acctbal DESC, c_mktsegment""",
    "avg_by_occupation": _over_people(f"""
        SELECT ocupacion, {_rounded_average("ingreso_mensual", 2)} AS avg_ingreso_mensual, count(*) AS n
        FROM p GROUP BY ocupacion ORDER BY avg_ingreso_mensual DESC, ocupacion"""),
    "avg1_by_key": _over_people(f"""
        SELECT nivel_estudios, {_rounded_average("edad", 1)} AS avg_edad, count(*) AS n
        FROM p GROUP BY nivel_estudios ORDER BY avg_edad DESC, nivel_estudios"""),
    "sql_filter_topk": _over_people("""
        SELECT id_persona, nombre, apellido, nivel_estudios, ocupacion, ingreso_mensual
        FROM p WHERE activo AND nivel_estudios IN ('Maestria', 'Doctorado')
        ORDER BY ingreso_mensual DESC, id_persona LIMIT 10"""),
    "sql_group_by_gender": _over_people(f"""
        SELECT ocupacion, genero, count(*) AS n,
               {_rounded_average("ingreso_mensual", 2)} AS avg_ingreso_mensual
        FROM p GROUP BY ocupacion, genero ORDER BY ocupacion, genero"""),
    "sql_group_topk": _over_people("""
        SELECT ciudad, estado, count(*) AS n
        FROM p WHERE ocupacion IN ('Ingeniero', 'Programador')
        GROUP BY ciudad, estado ORDER BY n DESC, ciudad, estado LIMIT 5"""),
    "sql_group_two_keys": c.SEGMENTS_BY_NATION.format(average=_rounded_average("c_acctbal", 2)),
    "heavy_group": f"""
        SELECT l_returnflag, l_linestatus, {_rounded_average("l_extendedprice", 6)} AS avg_l_extendedprice,
               {_rounded_average("l_quantity", 6)} AS avg_l_quantity, count(*) AS n
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "heavy_group_people": _over_people(f"""
        SELECT estado, ocupacion, {_rounded_average("ingreso_mensual", 6)} AS avg_ingreso_mensual,
               {_rounded_average("edad", 6)} AS avg_edad, count(*) AS n
        FROM p GROUP BY estado, ocupacion"""),
    "count_two_keys": _over_people("""
        SELECT nivel_estudios, genero, count(*) AS n FROM p GROUP BY nivel_estudios, genero"""),
    "group_cardinalities": _over_people("""
        SELECT (SELECT count(*) FROM (SELECT DISTINCT estado, ocupacion FROM p))
                   AS estado_ocupacion,
               (SELECT count(*) FROM (SELECT DISTINCT nivel_estudios, genero FROM p))
                   AS nivel_genero"""),
    "parse_json_messages": "SELECT event_id, (props->>'k')::INT AS k FROM events",
    "parse_person_messages": f"""WITH {_people(CUSTOMERS)}, {_people(SUPPLIERS, "s")}
        SELECT id_persona, nombre, apellido, edad, genero, ciudad, estado FROM p
        UNION ALL
        SELECT id_persona, nombre, apellido, edad, genero, ciudad, estado FROM s
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part""",
    "fanout_messages": FANOUT,
    "topics_join": JOINED,
    "merge_complete": MERGED,
    "merge_events": _merged_events(),
    "first_n_complete": FIRST_N_EVENTS,
    "completion_positions": COMPLETIONS,
    "first_n_people": f"{PEOPLE} ORDER BY id_persona LIMIT {c.FIRST_N_PEOPLE}",
    "topic_counters": """
        SELECT event_type, count(*) AS messages, (SELECT count(*) FROM events) AS total
        FROM events GROUP BY event_type""",
    "topic_counters_log": """
        WITH sizes AS (SELECT (SELECT count(*) FROM customer) AS c,
                              (SELECT count(*) FROM orders) AS o,
                              (SELECT count(*) FROM supplier) AS s,
                              (SELECT count(*) FROM part) AS p)
        SELECT 'personas' AS topic, c + s + p AS messages, p AS malformed,
               3 * c + 2 * o + 2 * s + p AS total FROM sizes
        UNION ALL SELECT 'empleos', c + s + o, 0, 3 * c + 2 * o + 2 * s + p FROM sizes
        UNION ALL SELECT 'actividad', c + o, 0, 3 * c + 2 * o + 2 * s + p FROM sizes""",
    "topic_monitor": MONITOR,
    "topic_monitor_first": MONITOR_FIRST,
    "topic_raw_first": RAW_FIRST,
    "live_count_by_group": f"""
        SELECT event_type, count(*) AS n, {_rounded_average("value", 1)} AS avg_value
        FROM events GROUP BY event_type ORDER BY n DESC, event_type""",
    "live_count_messages": f"""WITH {_people(CUSTOMERS)}, {_people(SUPPLIERS, "s")},
        sent AS (SELECT estado, edad FROM p UNION ALL SELECT estado, edad FROM s
                 UNION ALL SELECT NULL, NULL FROM part)
        SELECT estado, count(*) AS n, {_rounded_average("edad", 1)} AS avg_edad FROM sent
        GROUP BY estado ORDER BY n DESC, estado NULLS FIRST""",
    "stream_merge_complete": MERGED,
    "stream_resume": MERGED,
    "stream_input_rows": f"""
        SELECT count(*) AS batches, sum(input_rows)::BIGINT AS input_rows FROM ({PROGRESS})""",
    "synth_people": PEOPLE,
    "synth_resume": PEOPLE,
    "synth_stream": FANOUT,
}
