"""The SQL each query must agree with, written independently of the Spark plans."""

DIM = 64
WINDOW = 4
WIDE = 40


def spread(prefix: str, column: str, dim: int = DIM) -> str:
    return ", ".join(f"CAST({column}[{k + 1}] AS DOUBLE) AS {prefix}_{k}" for k in range(dim))


def window_cells(column: str = "w", size: int = WINDOW) -> str:
    return ", ".join(f"{column}[{k + 1}] AS w{k}" for k in range(size))


def frame(order: str, size: int = WINDOW, partition: str = "") -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    return f"({by}ORDER BY {order} ROWS BETWEEN {size} PRECEDING AND 1 PRECEDING)"


ZEROS = f"list_transform(range({DIM}), lambda i: CAST(0 AS FLOAT))"

HASH = "CAST(CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 600 AS INTEGER)"

DOCUMENT_WORDS = """
split AS (
  SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda s: s <> '') AS ws
  FROM documents),
words AS (
  SELECT doc_id, CAST(unnest(range(len(ws))) AS INTEGER) AS pos, unnest(ws) AS word
  FROM split),
tokens AS (
  SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS idx, doc_id, pos,
         {hash} AS token_id
  FROM words)
""".format(hash=HASH)

CONVERSATION_WORDS = """
split AS (
  SELECT conv_id, turn, list_filter(string_split_regex(text, '\\s+'), lambda s: s <> '') AS ws
  FROM conversations),
words AS (
  SELECT conv_id, turn, CAST(unnest(range(len(ws))) AS INTEGER) AS pos, unnest(ws) AS word
  FROM split),
tokens AS (
  SELECT conv_id, turn, pos, {hash} AS token_id FROM words)
""".format(hash=HASH)

SPARSE = f"""
tokens AS (
  SELECT event_id, CAST(user_id * 7 % 600 AS INTEGER) AS token_id FROM events),
found AS (
  SELECT t.event_id, t.token_id, e.vec_id IS NOT NULL AS hit,
         COALESCE(e.embedding, {ZEROS}) AS vec
  FROM tokens t LEFT JOIN embeddings e ON e.vec_id = t.token_id)
"""

MESSY_WINDOW = 20


def encoding(size: int) -> str:
    return f"""
encoding AS (
  SELECT step, list_transform(range({DIM}), lambda i: CAST(
           CASE WHEN i % 2 = 0
                THEN sin(CAST(step AS DOUBLE) / pow(10000.0, 2 * (i // 2) / {DIM}.0::DOUBLE))
                ELSE cos(CAST(step AS DOUBLE) / pow(10000.0, 2 * (i // 2) / {DIM}.0::DOUBLE))
           END AS FLOAT)) AS pe
  FROM (SELECT unnest(range({size})) AS step))
"""


MATRIX = f"""
{SPARSE}, {encoding(WINDOW)},
matrix AS (
  SELECT y.event_id AS example_id, CAST(p.step AS INTEGER) AS step, y.vec AS y,
         list_transform(range(1, {DIM + 1}), lambda k: x.vec[k] + p.pe[k]) AS x
  FROM found y CROSS JOIN encoding p
  JOIN found x ON x.event_id = y.event_id - {WINDOW} + p.step
  WHERE y.event_id >= {WINDOW})
"""

MESSY = f"""
tokens AS (
  SELECT event_id, CAST(user_id * 7 % 600 AS INTEGER) AS token_id FROM events),
found AS (
  SELECT t.event_id,
         CASE WHEN e.vec_id IS NULL OR e.vec_id % 7 = 0 THEN {ZEROS}
              WHEN e.vec_id % 11 = 0 THEN e.embedding[1:5] ELSE e.embedding END AS vec
  FROM tokens t LEFT JOIN embeddings e ON e.vec_id = t.token_id)
"""


def messy_matrix(size: int) -> str:
    return f"""
WITH {MESSY}, {encoding(size)},
matrix AS (
  SELECT y.event_id AS example_id, CAST(p.step AS INTEGER) AS step, y.vec AS y,
         CASE WHEN len(x.vec) = {DIM}
              THEN list_transform(range(1, {DIM + 1}), lambda k: x.vec[k] + p.pe[k])
              ELSE {ZEROS} END AS x
  FROM found y CROSS JOIN encoding p
  JOIN found x ON x.event_id = y.event_id - {size} + p.step
  WHERE y.event_id >= {size})
SELECT example_id, step, CAST(len(y) AS INTEGER) AS y_size, CAST(y[1] AS DOUBLE) AS y_0,
       {spread('x', 'x')}
FROM matrix
"""


def parameter(place: str) -> str:
    return f"((({place}) * 37) % 101 - 50) / CAST(500 AS DOUBLE)"


def predicted(steps: int = WINDOW) -> str:
    """Four gates of one hidden unit, step after step."""
    gates = ", ".join(
        f"list_sum(list_transform(range({DIM}), lambda k: CAST(x[k + 1] AS DOUBLE) * "
        f"({parameter(f'k * 4 + {g}')}))) + {parameter(str(4 * DIM + 4 + g))} AS z{g}"
        for g in range(4)
    )
    parts = [
        f"gates AS (SELECT example_id, step, y, {gates} FROM matrix)",
        "state0 AS (SELECT DISTINCT example_id, CAST(0 AS DOUBLE) AS h, CAST(0 AS DOUBLE) AS c FROM gates)",
    ]
    for t in range(steps):
        z = [f"z{g} + h * {parameter(str(4 * DIM + g))} AS a{g}" for g in range(4)]
        parts.append(
            f"open{t} AS (SELECT g.example_id, g.y, c, {', '.join(z)} "
            f"FROM gates g JOIN state{t} s ON s.example_id = g.example_id WHERE step = {t})"
        )
        parts.append(
            f"cell{t} AS (SELECT example_id, y, a2, "
            f"c / (1 + exp(-a1)) + tanh(a3) / (1 + exp(-a0)) AS c FROM open{t})"
        )
        parts.append(
            f"state{t + 1} AS (SELECT example_id, y, c, tanh(c) / (1 + exp(-a2)) AS h FROM cell{t})"
        )
    states = " UNION ALL ".join(f"SELECT y, h FROM state{t + 1}" for t in range(steps))
    out = f"h * ({parameter(f'{4 * DIM + 8} + dim')}) + {parameter(f'{5 * DIM + 8} + dim')}"
    parts.append(
        f"cells AS (SELECT dim, y, {out} AS p FROM ("
        f"SELECT unnest(range({DIM})) AS dim, CAST(unnest(y) AS DOUBLE) AS y, h FROM ({states})))"
    )
    return ",\n".join(parts)


INPUT_MATRIX = f"WITH {MATRIX} SELECT example_id, step, {spread('x', 'x')} FROM matrix"

LOOKUP = f"WITH {SPARSE} SELECT event_id, token_id, hit, {spread('v', 'vec')} FROM found"

PER_USER = f"""
WITH tokens AS (
  SELECT user_id, event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS token_id
  FROM events),
windows AS (
  SELECT *, list(token_id) OVER {frame('event_id', partition='user_id')} AS w FROM tokens)
SELECT user_id, event_id, {window_cells()}, token_id AS target_token
FROM windows WHERE len(w) = {WINDOW}
"""

EVENT_WINDOWS = f"""
WITH windows AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS target_token,
         list(CAST(user_id AS INTEGER)) OVER {frame('event_id')} AS w
  FROM events)
SELECT event_id AS example_id, {window_cells()}, target_token
FROM windows WHERE len(w) = {WINDOW}
"""

ID_LISTS = """
raw AS (
  SELECT event_id, user_id, event_type, regexp_extract(props, '([0-9]+)', 1) AS k FROM events),
lists AS (
  SELECT event_id, CASE WHEN event_id % 50 = 0 THEN ' [ , ] ' WHEN event_id % 50 = 1 THEN NULL
    ELSE CASE event_type
    WHEN 'error' THEN '[' || user_id || ', x, ' || event_id || ']'
    WHEN 'view' THEN ' [' || user_id || ',,' || k || '] '
    WHEN 'click' THEN user_id || ' ' || event_id || ' -' || k
    WHEN 'purchase' THEN '[[' || user_id || ']]'
    ELSE '[' || user_id || ', ' || event_id || ']' END END AS tokens
  FROM raw),
pieces AS (
  SELECT event_id, tokens, list_filter(string_split_regex(
           regexp_replace(regexp_replace(trim(tokens), '^\\[', ''), '\\]$', ''),
           '[,\\s]+'), lambda s: s <> '') AS ps
  FROM lists),
parsed AS (
  SELECT event_id, tokens,
         CASE WHEN len(list_filter(ps, lambda s: TRY_CAST(s AS INTEGER) IS NULL)) = 0
              THEN CAST(ps AS INTEGER[]) ELSE [] END AS ids, len(ps) AS n_pieces
  FROM pieces)
"""

ITERATIONS = """
log AS (
  SELECT user_id AS run_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day,
         event_id AS iteration, ts, value AS loss,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS gradient_norm
  FROM events),
epochs AS (
  SELECT run_id, CAST(day AS INTEGER) AS epoch,
         epoch_us(date_trunc('day', min(ts))) // 1000 AS start_ts,
         epoch_us(max(ts)) // 1000 AS end_ts,
         epoch_us(max(ts)) // 1000 - epoch_us(date_trunc('day', min(ts))) // 1000 AS duration_ms
  FROM log GROUP BY run_id, day)
"""

# Every element of the stand-in forecast: target y, step vector p.
FORECAST = f"""
{SPARSE},
cells AS (
  SELECT y.event_id, unnest(range({DIM})) AS dim,
         CAST(unnest(y.vec) AS DOUBLE) AS y, CAST(unnest(x.vec) AS DOUBLE) AS p
  FROM found y JOIN found x ON x.event_id BETWEEN y.event_id - {WINDOW} AND y.event_id - 1
  WHERE y.event_id >= {WINDOW})
"""

SCORES = """
  count(*) AS n, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse,
  avg(abs(y - p)) AS mae,
  1 - avg((y - p) * (y - p)) / nullif(var_pop(y), 0) AS r2
"""

ORACLE: dict[str, str] = {
    "sequence_index_events": """
SELECT row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS idx, event_id FROM events
""",
    "token_index_documents": f"WITH {DOCUMENT_WORDS} SELECT idx, doc_id, pos, token_id FROM tokens",
    "sliding_window_events": EVENT_WINDOWS,
    "sliding_window_events_wide": f"""
WITH windows AS (
  SELECT event_id, user_id, list(user_id) OVER {frame('event_id', WIDE)} AS w FROM events)
SELECT event_id AS example_id, array_to_string(w, ',') AS inputs,
       CAST(user_id AS INTEGER) AS target_token
FROM windows WHERE len(w) = {WIDE}
""",
    "sliding_window_documents": f"""
WITH {DOCUMENT_WORDS},
windows AS (SELECT idx, token_id, list(token_id) OVER {frame('idx')} AS w FROM tokens)
SELECT idx AS example_id, {window_cells()}, token_id AS target_token
FROM windows WHERE len(w) = {WINDOW}
""",
    "sliding_window_per_user": PER_USER,
    "sliding_window_per_user_hot": PER_USER,
    "sliding_window_conversation": f"""
WITH {CONVERSATION_WORDS},
windows AS (
  SELECT *, list(token_id) OVER {frame('turn, pos', partition='conv_id')} AS w FROM tokens)
SELECT conv_id, turn, pos, {window_cells()}, token_id AS target_token
FROM windows WHERE len(w) = {WINDOW}
""",
    "parse_id_list": f"""
WITH {ID_LISTS}
SELECT event_id, CAST(len(ids) AS INTEGER) AS n_ids, array_to_string(ids, ',') AS ids FROM parsed
""",
    "scan_token_lists_csv": f"WITH {DOCUMENT_WORDS} SELECT idx, token_id FROM tokens",
    "token_lists_appended": f"WITH {DOCUMENT_WORDS} SELECT idx, token_id FROM tokens",
    "scan_token_lists_text": f"""
WITH {CONVERSATION_WORDS}
SELECT row_number() OVER (ORDER BY conv_id, turn, pos) - 1 AS idx, token_id FROM tokens
""",
    "scan_embeddings_csv": f"""
SELECT CAST(vec_id AS INTEGER) AS token_id, {spread('v', 'embedding')} FROM embeddings
""",
    "scan_embeddings_csv_bad_ids": f"""
SELECT CAST(vec_id AS INTEGER) AS token_id, {spread('v', 'embedding')} FROM embeddings
WHERE vec_id % 5 <> 0
""",
    "rejected_embedding_rows": """
WITH lines AS (
  SELECT vec_id, copy, CASE WHEN vec_id % 7 = 0 THEN NULL WHEN vec_id % 5 = 0 THEN 'x' || vec_id ELSE CAST(vec_id AS VARCHAR) END AS id
  FROM embeddings CROSS JOIN (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR vec_id % 3 = 0),
told AS (
  SELECT CASE WHEN id LIKE 'x%' THEN id || ',' || (vec_id % 10) ELSE id END AS raw,
         CASE WHEN id IS NULL THEN 'no id' WHEN id LIKE 'x%' THEN 'unreadable id'
              WHEN copy = 0 AND vec_id % 3 = 0 THEN 'replaced' END AS reason
  FROM lines)
SELECT raw, reason, (SELECT count(*) FROM told WHERE reason IS NULL) AS kept FROM told WHERE reason IS NOT NULL
""",
    "rejected_token_lists": f"""
WITH {ID_LISTS}
SELECT tokens AS raw, 'unreadable list' AS reason, (SELECT CAST(sum(len(ids)) AS BIGINT) FROM parsed) AS ids,
       (SELECT CAST(sum(len(ids)) AS BIGINT) FROM parsed) AS numbered
FROM parsed WHERE n_pieces > 0 AND len(ids) = 0
""",
    "rejected_examples": f"""
WITH {MESSY}
SELECT event_id AS example_id, CASE WHEN len(vec) = {DIM} THEN 'kept' ELSE 'target of another length' END AS reason
FROM found WHERE event_id >= {WINDOW}
""",
    "published_windows": f"""
SELECT *, CAST(2 AS BIGINT) AS version, (SELECT count(*) - {WINDOW} FROM events) AS n_rows FROM ({EVENT_WINDOWS})
""",
    "pack_vector": """
SELECT p_partkey, CAST(CAST(p_size AS FLOAT) AS DOUBLE) AS v_0,
       CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS v_1
FROM part
""",
    "stored_windows": EVENT_WINDOWS,
    "examples_text": f"""
WITH {MATRIX} SELECT example_id, step, {spread('x', 'x')}, {spread('y', 'y')} FROM matrix
""",
    "dedupe_by_key_last": """
SELECT CAST(user_id AS INTEGER) AS token_id,
       CAST(CAST(arg_max(value, event_id) AS FLOAT) AS DOUBLE) AS v_0
FROM events GROUP BY user_id
""",
    "lookup_embedding": LOOKUP,
    "lookup_embedding_large": LOOKUP,
    "lookup_embedding_hot": f"""
WITH tokens AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7
                        ELSE CAST(user_id * 7 % 600 AS INTEGER) END AS token_id
  FROM events)
SELECT event_id, CAST(token_id AS INTEGER) AS token_id, vec_id IS NOT NULL AS hit,
       {spread('v', f'COALESCE(embedding, {ZEROS})')}
FROM tokens LEFT JOIN embeddings ON vec_id = token_id
""",
    "lookup_embedding_bucketed": f"""
WITH tokens AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7
                        ELSE CAST(user_id * 7 % 600 AS INTEGER) END AS token_id
  FROM events)
SELECT event_id, CAST(token_id AS INTEGER) AS token_id, vec_id IS NOT NULL AS hit,
       {spread('v', f'COALESCE(embedding, {ZEROS})')}
FROM tokens LEFT JOIN embeddings ON vec_id = token_id
""",
    "positional_encoding": "SELECT conv_id, turn, "
    + ", ".join(
        f"CAST(CAST({'cos' if i % 2 else 'sin'}(CAST(turn AS DOUBLE) / "
        f"pow(10000.0, {2 * (i // 2)} / CAST(50 AS DOUBLE))) AS FLOAT) AS DOUBLE) AS pe_{i}"
        for i in range(50)
    )
    + " FROM conversations",
    "input_matrix": INPUT_MATRIX,
    "input_matrix_large": INPUT_MATRIX,
    "embed_windows": INPUT_MATRIX,
    "embed_windows_large": INPUT_MATRIX,
    "embed_windows_gaps_large": f"{INPUT_MATRIX} WHERE example_id % 10 NOT IN (3, 4) AND example_id % 97 > 6",
    "step_targets": f"""
WITH {SPARSE}
SELECT f.event_id + {WINDOW} - 1 - step AS example_id, CAST(step AS INTEGER) AS step, {spread('y', 'f.vec')}
FROM found f CROSS JOIN (SELECT unnest(range({WINDOW})) AS step)
WHERE f.event_id + {WINDOW} - 1 - step BETWEEN {WINDOW} AND (SELECT max(event_id) FROM events)
""",
    "step_target_series_large": f"""
WITH {SPARSE},
cells AS (
  SELECT event_id, CAST(unnest(range({DIM})) AS INTEGER) AS dim, CAST(unnest(vec) AS DOUBLE) AS value FROM found)
SELECT example_id, dim, {', '.join(f'max(value) FILTER (WHERE step = {s}) AS t_{s}' for s in range(WINDOW))}
FROM (SELECT event_id + {WINDOW} - 1 - step AS example_id, dim, step, value
      FROM cells CROSS JOIN (SELECT unnest(range({WINDOW})) AS step))
WHERE example_id BETWEEN {WINDOW} AND (SELECT max(event_id) FROM events) GROUP BY example_id, dim
""",
    "prepare_counts": f"""
WITH {MESSY},
kept AS (
  SELECT CASE WHEN CAST('0x' || substr(md5('split:' || event_id), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'valid' END AS side
  FROM found WHERE event_id >= {WINDOW} AND len(vec) = {DIM}),
twice AS (SELECT count(*) AS n FROM embeddings WHERE vec_id % 3 = 0)
SELECT 'embeddings' AS part, 'n_rows' AS item, count(*) + (SELECT n FROM twice) AS n FROM embeddings
UNION ALL SELECT 'embeddings', 'null_ids', 0
UNION ALL SELECT 'embeddings', 'repeated_ids', n FROM twice
UNION ALL SELECT 'embeddings', 'wrong_length', count(*) FROM embeddings WHERE vec_id % 7 = 0 OR vec_id % 11 = 0
UNION ALL SELECT 'tokens', 'n_rows', count(*) FROM events
UNION ALL SELECT 'tokens', 'null_ids', count(*) FROM events WHERE user_id IS NULL
UNION ALL SELECT 'examples', 'kept', count(*) FROM kept
UNION ALL SELECT 'examples', 'dropped', (SELECT count(*) FROM events) - {WINDOW} - count(*) FROM kept
UNION ALL SELECT 'splits', side, count(*) FROM kept GROUP BY side
UNION ALL SELECT 'stored', side, count(*) FROM kept GROUP BY side
""",
    "input_matrix_messy": messy_matrix(WINDOW),
    "input_matrix_messy_large": messy_matrix(WINDOW),
    "input_matrix_messy_wide": messy_matrix(MESSY_WINDOW),
    "embed_windows_messy_large": messy_matrix(WINDOW),
    "keep_complete_examples": f"""
WITH {MESSY}
SELECT event_id AS example_id, {spread('y', 'vec')} FROM found
WHERE event_id >= {WINDOW} AND len(vec) = {DIM}
""",
    "training_pairs": f"""
WITH {MATRIX} SELECT example_id, step, {spread('x', 'x')}, {spread('y', 'y')} FROM matrix
""",
    "target_vector": f"WITH {SPARSE} SELECT event_id, {spread('y', 'vec')} FROM found",
    "tile_target": f"""
WITH {SPARSE}
SELECT event_id AS example_id, CAST(step AS INTEGER) AS step, {spread('y', 'vec')}
FROM found CROSS JOIN (SELECT unnest(range({WINDOW})) AS step) WHERE event_id >= {WINDOW}
""",
    "time_series_transpose": f"""
WITH {MATRIX},
cells AS (
  SELECT example_id, step, CAST(unnest(range({DIM})) AS INTEGER) AS dim,
         CAST(unnest(x) AS DOUBLE) AS value
  FROM matrix)
SELECT example_id, dim, {', '.join(
    f'max(value) FILTER (WHERE step = {s}) AS t_{s}' for s in range(WINDOW))}
FROM cells GROUP BY example_id, dim
""",
    "check_tokens": """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE user_id IS NULL) AS null_ids,
       count(DISTINCT user_id * 7 % 600) AS distinct_ids
FROM events
""",
    "check_embeddings": f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE vec_id IS NULL) AS null_ids,
       count(vec_id) - count(DISTINCT vec_id) AS repeated_ids,
       count(*) FILTER (WHERE len(embedding) <> {DIM}) AS wrong_length
FROM embeddings
""",
    "check_lists": f"""
WITH {ID_LISTS}
SELECT count(*) AS n_rows, count(*) FILTER (WHERE tokens IS NULL) AS null_lists,
       count(*) FILTER (WHERE n_pieces > 0 AND len(ids) = 0) AS bad_lists
FROM parsed
""",
    "train_valid_split": """
SELECT event_id, CASE WHEN
         CAST('0x' || substr(md5('split:' || event_id), 1, 8) AS BIGINT) % 100 < 80
       THEN 'train' ELSE 'valid' END AS split
FROM events
""",
    "vector_norm": """
SELECT vec_id, round(sqrt(list_sum(list_transform(embedding,
         lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm
FROM embeddings
""",
    "regression_eval": f"""
WITH {FORECAST}
SELECT CAST(dim AS INTEGER) AS dim, n, round(mse, 6) AS mse, round(rmse, 6) AS rmse,
       round(mae, 6) AS mae, round(r2, 6) AS r2
FROM (SELECT dim, {SCORES} FROM cells GROUP BY dim)
""",
    "macro_average": f"""
WITH {FORECAST}
SELECT count(*) AS dims, count(r2) AS r2_dims, round(avg(mse), 6) AS mse,
       round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae, round(avg(r2), 6) AS r2
FROM (SELECT dim, {SCORES} FROM cells GROUP BY dim)
""",
    "score_iterations": f"""
WITH {ITERATIONS}
SELECT run_id, CAST(day AS INTEGER) AS epoch, iteration, loss FROM log WHERE iteration % 10 = 0
""",
    "throughput": f"""
WITH {ITERATIONS}
SELECT run_id, count(*) AS iterations,
       round(count(*) / nullif((epoch_us(max(ts)) - epoch_us(date_trunc('day', min(ts)))) / 1e6, 0), 6)
         AS iterations_per_second
FROM log GROUP BY run_id
""",
    "epoch_durations": f"WITH {ITERATIONS} SELECT * FROM epochs",
    "epoch_final_metrics": f"""
WITH {ITERATIONS}
SELECT run_id, CAST(day AS INTEGER) AS epoch, arg_max(loss, iteration) AS loss,
       arg_max(gradient_norm, iteration) AS gradient_norm
FROM log GROUP BY run_id, day
""",
    "average_epoch_time": f"""
WITH {ITERATIONS}
SELECT run_id, count(*) AS epochs,
       CAST(CAST(sum(duration_ms) AS BIGINT) // count(*) AS BIGINT) AS average_epoch_ms
FROM epochs GROUP BY run_id
""",
    "run_summary": f"""
WITH {ITERATIONS},
runs AS (
  SELECT run_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts,
         (max(end_ts) - min(start_ts)) // 60000 AS total_minutes,
         count(*) AS epochs,
         CAST(CAST(sum(duration_ms) AS BIGINT) // count(*) AS BIGINT) AS average_epoch_ms
  FROM epochs GROUP BY run_id)
SELECT run_id, start_ts, end_ts, total_minutes, epochs, average_epoch_ms,
       c_nationkey AS batch_size, CAST(len(c_name) AS INTEGER) AS hidden_size
FROM runs LEFT JOIN customer ON c_custkey = run_id
""",
    "epoch_validation": f"""
WITH {FORECAST},
days AS (
  SELECT event_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch,
         ts
  FROM events),
scores AS (
  SELECT epoch, dim, {SCORES} FROM cells JOIN days USING (event_id) GROUP BY epoch, dim),
averages AS (
  SELECT epoch, avg(mse) AS mse, avg(rmse) AS rmse, avg(mae) AS mae, avg(r2) AS r2
  FROM scores GROUP BY epoch),
durations AS (
  SELECT epoch,
         epoch_us(max(ts)) // 1000 - epoch_us(date_trunc('day', min(ts))) // 1000 AS duration_ms
  FROM days GROUP BY epoch)
SELECT d.epoch, d.duration_ms, round(mse, 6) AS mse, round(rmse, 6) AS rmse,
       round(mae, 6) AS mae, round(r2, 6) AS r2
FROM durations d LEFT JOIN averages a ON a.epoch = d.epoch
""",
    "parameter_norms": """
WITH cells AS (
  SELECT vec_id, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS value
  FROM embeddings),
changes AS (
  SELECT c.vec_id, c.value, c.value - COALESCE(b.value, c.value) AS change
  FROM cells c LEFT JOIN cells b ON b.vec_id = c.vec_id - 1 AND b.i = c.i)
SELECT vec_id AS epoch, round(sqrt(sum(value * value)), 6) AS parameter_norm,
       round(sqrt(sum(change * change)), 6) AS parameter_update
FROM changes GROUP BY vec_id
""",
    "layer_info": """
SELECT label AS layer, COALESCE(max(r_name), 'Unknown') AS kind,
       CAST(sum(len(embedding)) AS BIGINT) AS parameters,
       CASE WHEN max(r_name) IS NULL THEN 0 ELSE 64 END AS n_in,
       CASE WHEN max(r_name) IS NULL THEN 0 ELSE 64 END AS n_out,
       CASE WHEN max(r_name) IS NULL THEN 'Unknown' ELSE 'tanh' END AS activation
FROM embeddings LEFT JOIN region ON r_regionkey = label GROUP BY label
""",
    "predict_untrained": f"""
WITH {MATRIX},
{predicted()}
SELECT count(*) AS dims, count(r2) AS r2_dims, round(avg(mse), 4) AS mse,
       round(avg(rmse), 4) AS rmse, round(avg(mae), 4) AS mae, round(avg(r2), 4) AS r2
FROM (SELECT dim, {SCORES} FROM cells GROUP BY dim)
""",
    "train_metrics": f"""
WITH kept AS (
  SELECT count(*) AS rows_trained FROM events
  WHERE event_id >= {WINDOW}
    AND CAST('0x' || substr(md5('split:' || event_id), 1, 8) AS BIGINT) % 100 < 80)
SELECT CAST(epoch AS INTEGER) AS epoch, rows_trained, CAST({DIM} AS BIGINT) AS dims
FROM kept CROSS JOIN (SELECT unnest([1, 2]) AS epoch)
""",
    "train_resumed": f"""
WITH kept AS (
  SELECT count(*) AS n FROM events
  WHERE event_id >= {WINDOW}
    AND CAST('0x' || substr(md5('split:' || event_id), 1, 8) AS BIGINT) % 100 < 80)
SELECT CAST(epoch AS INTEGER) AS epoch, n AS rows_whole, n AS rows_cut, CAST(0 AS DOUBLE) AS largest_gap,
       CAST(2 AS BIGINT) AS runs, CAST(4 * 4 * ({DIM} + 4 + 1) + 4 * {DIM} + {DIM} AS BIGINT) AS parameters,
       CAST(1 AS INTEGER) AS epochs_before
FROM kept CROSS JOIN (SELECT unnest([1, 2]) AS epoch)
""",
    "average_parameters": f"""
WITH cells AS (
  SELECT label + 1 AS n, vec_id, CAST(unnest(range({DIM})) AS INTEGER) AS pos,
         unnest(embedding) AS x
  FROM embeddings),
means AS (
  SELECT pos, max(vec_id) AS step, avg(CAST(x AS DOUBLE)) AS params,
         avg(CAST(x * x AS DOUBLE)) AS m, avg(CAST(abs(x) AS DOUBLE)) AS v,
         sum(CAST(x AS DOUBLE) * n) / sum(n) AS wp, sum(CAST(x * x AS DOUBLE) * n) / sum(n) AS wm,
         sum(CAST(abs(x) AS DOUBLE) * n) / sum(n) AS wv
  FROM cells GROUP BY pos)
SELECT pos, step, {', '.join(
    f'round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS {name}'
    for c, name in zip(
        ('params', 'm', 'v', 'wp', 'wm', 'wv'),
        ('params', 'm', 'v', 'weighted_params', 'weighted_m', 'weighted_v'),
        strict=True))}
FROM means
""",
    "round_plan": """
SELECT event_id,
       CAST(CAST('0x' || substr(md5('round:' || event_id), 1, 8) AS BIGINT) % 7 AS INTEGER) AS round
FROM events
""",
    "stored_model": f"""
WITH cells AS (
  SELECT vec_id, unnest(range({DIM})) AS pos, unnest(embedding) AS x FROM embeddings),
means AS (
  SELECT pos, max(vec_id) AS step, CAST(avg(CAST(x AS DOUBLE)) AS FLOAT) AS value
  FROM cells GROUP BY pos),
blocks AS (
  SELECT * FROM (VALUES (0, 12, 0, 'input_weight'), (12, 48, 0, 'recurrent_weight'),
                        (48, 60, 0, 'bias'), (60, 63, 1, 'weight'), (63, 64, 1, 'bias'))
           AS b (low, high, layer, name))
SELECT 1 AS epoch, layer, name, CAST(pos - low AS BIGINT) AS param_idx, step,
       round(CAST(value AS DOUBLE), 6) AS value
FROM means JOIN blocks ON pos >= low AND pos < high
""",
    "stored_stats": f"""
WITH {ITERATIONS},
spans AS (
  SELECT CAST(day AS INTEGER) AS epoch, epoch_us(date_trunc('day', min(ts))) // 1000 AS low,
         epoch_us(max(ts)) // 1000 AS high, count(*) AS dims, max(loss) AS mse, min(loss) AS mae,
         arg_max(loss, iteration) AS loss, arg_max(gradient_norm, iteration) AS norm
  FROM log GROUP BY day),
run AS (
  SELECT min(low) AS low, max(high) AS high, count(*) AS epochs, sum(dims) AS n,
         CAST(sum(high - low) AS BIGINT) // count(*) AS mean
  FROM spans),
last AS (SELECT epoch_us(max(ts)) AS last_us FROM log),
figures AS (
  {' UNION ALL '.join(
    f"SELECT '{report}' AS report, {epoch} AS epoch, '{item}' AS item, CAST({value} AS DOUBLE) AS value FROM {source}"
    for report, epoch, item, value, source in (
        ('epochs', 'epoch', 'duration_ms', 'high - low', 'spans'),
        ('epochs', 'epoch', 'dims', 'dims', 'spans'),
        ('epochs', 'epoch', 'mse', 'mse', 'spans'),
        ('epochs', 'epoch', 'mae', 'mae', 'spans'),
        ('final_metrics', 'epoch', 'loss', 'loss', 'spans'),
        ('final_metrics', 'epoch', 'learning_rate', 'loss / 4', 'spans'),
        ('final_metrics', 'epoch', 'gradient_norm', 'norm', 'spans'),
        ('throughput', '0', 'iterations', 'n', 'run'),
        ('throughput', '0', 'iterations_per_second', 'n / ((last_us - low * 1000) / 1e6)', 'run, last'),
        ('summary', '0', 'start_ts', 'low', 'run'),
        ('summary', '0', 'end_ts', 'high', 'run'),
        ('summary', '0', 'total_minutes', '(high - low) // 60000', 'run'),
        ('summary', '0', 'epochs', 'epochs', 'run'),
        ('summary', '0', 'average_epoch_ms', 'mean', 'run'),
        ('summary', '0', 'batch_size', '32', 'run'),
        ('summary', '0', 'hidden_size', '9', 'run')))})
SELECT report, epoch, item, round(value, 6) AS value FROM figures
""",
}
