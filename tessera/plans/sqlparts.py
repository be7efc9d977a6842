"""SQL twins of the catalog's shared intermediate frames, as named CTEs.

``with_ctes(final, *names)`` emits ``WITH`` followed by the named CTEs and
their dependencies in definition order, then ``final``. The text is DuckDB
SQL over the shared tables; it is the oracle, not part of the Spark path.
"""

from __future__ import annotations

from tessera.plans.params import (
    COLD_SEED, COLD_USER_FRAC, GENRE_POSITIVE, SCORE_SEED, SPLIT_SEED, STRAT_FRAC, STRAT_SEED,
    TRAIN_FRAC, REPAIR_FRAC, REPAIR_SEED,
)
from tessera.sources.fixtures import (
    ACCEPTED_LINES_SQL, GENRE_LABELS_SQL, MISMATCH_LINES_SQL, TRACK_FEATURES_SQL, TRIPLETS_SQL,
)


def u_sql(key_cols: list[str], seed) -> str:
    """DuckDB twin of ``functions.uniform``."""
    return f"(('0x' || substr({h_sql(key_cols, seed)}, 1, 8))::BIGINT / 4294967296.0)"


def h_sql(key_cols: list[str], seed) -> str:
    """DuckDB twin of ``functions.hash_key``."""
    parts = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in key_cols)
    return f"md5({parts} || '#{seed}')"


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


# (name, dependencies, body)
CTES: list[tuple[str, tuple[str, ...], str]] = [
    ("trip", (), TRIPLETS_SQL),
    ("mis_lines", (), MISMATCH_LINES_SQL),
    ("acc_lines", (), ACCEPTED_LINES_SQL),
    ("line_ids", ("mis_lines",),
     "SELECT trim(substr(value, 9, 18)) AS song_id, trim(substr(value, 27, 19)) AS track_id FROM mis_lines"),
    ("mis", ("mis_lines",),
     "SELECT trim(substr(value, 9, 18)) AS song_id, trim(substr(value, 27, 19)) AS track_id FROM mis_lines "
     "WHERE starts_with(value, 'ERROR: ')"),
    ("acc", ("acc_lines",),
     "SELECT trim(substr(value, 11, 18)) AS song_id, trim(substr(value, 29, 19)) AS track_id "
     "FROM acc_lines WHERE starts_with(value, '< ERROR: ')"),
    ("eff", ("mis", "acc"),
     "SELECT * FROM mis m WHERE NOT EXISTS (SELECT 1 FROM acc a WHERE a.track_id = m.track_id)"),
    ("clean", ("trip", "eff"),
     "SELECT * FROM trip t WHERE NOT EXISTS (SELECT 1 FROM eff e WHERE e.song_id = t.song_id)"),
    ("ua", ("clean",),
     "SELECT user_id, count(play_count) AS n_songs, CAST(sum(play_count) AS BIGINT) AS total_plays "
     "FROM clean GROUP BY user_id"),
    ("sp", ("clean",),
     "SELECT song_id, count(user_id) AS n_users, CAST(sum(play_count) AS BIGINT) AS total_plays "
     "FROM clean GROUP BY song_id"),
    ("reduced", ("clean", "ua", "sp"),
     "SELECT c.* FROM clean c "
     "WHERE c.song_id IN (SELECT song_id FROM sp WHERE total_plays > "
     "(SELECT quantile_disc(total_plays, 0.5) FROM sp)) "
     "AND c.user_id IN (SELECT user_id FROM ua WHERE n_songs > "
     "(SELECT quantile_disc(n_songs, 0.5) FROM ua))"),
    ("splitted", ("reduced",),
     f"SELECT user_id, song_id, play_count, CASE WHEN {u_sql(['user_id', 'song_id'], SPLIT_SEED)} "
     f"< {_d(TRAIN_FRAC)} THEN 'train' ELSE 'test' END AS split FROM reduced"),
    ("cold", ("splitted",),
     f"SELECT user_id, song_id, play_count, CASE WHEN {u_sql(['user_id'], COLD_SEED)} < {_d(COLD_USER_FRAC)} "
     "THEN 'test' ELSE split END AS split FROM splitted"),
    ("unc", ("cold",),
     "SELECT * FROM cold s WHERE split = 'test' AND NOT EXISTS "
     "(SELECT 1 FROM cold t WHERE t.split = 'train' AND t.user_id = s.user_id)"),
    ("repaired", ("cold", "unc"),
     f"SELECT user_id, song_id, play_count, CASE WHEN row_number() OVER (PARTITION BY user_id "
     f"ORDER BY {h_sql(['user_id', 'song_id'], REPAIR_SEED)}) < count(*) OVER (PARTITION BY user_id) "
     f"* {_d(REPAIR_FRAC)} THEN 'train' ELSE 'test' END AS split FROM unc "
     "UNION ALL SELECT s.* FROM cold s WHERE NOT EXISTS "
     "(SELECT 1 FROM unc u WHERE u.user_id = s.user_id AND u.song_id = s.song_id)"),
    ("feat_raw", (), TRACK_FEATURES_SQL),
    ("feat", ("feat_raw",),
     "SELECT trim(track_id, '\"') AS track_id, f_lines, f_quantity, f_revenue, f_discount, f_tax, "
     "f_price, f_size, f_key FROM feat_raw"),
    ("genre", (), GENRE_LABELS_SQL),
    ("genre_ok", ("genre", "eff"),
     "SELECT * FROM genre g WHERE NOT EXISTS (SELECT 1 FROM eff e WHERE e.track_id = g.track_id)"),
    ("labelled", ("feat", "genre_ok"),
     "SELECT f.*, g.genre FROM feat f JOIN genre_ok g ON f.track_id = g.track_id"),
    ("binlab", ("labelled",),
     f"SELECT *, CASE WHEN genre = '{GENRE_POSITIVE}' THEN 1 ELSE 0 END AS label FROM labelled"),
    ("strat", ("binlab",),
     f"SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY "
     f"{h_sql(['track_id'], STRAT_SEED)}) < count(*) OVER (PARTITION BY label) * {_d(STRAT_FRAC)} "
     "THEN 'train' ELSE 'test' END AS split FROM binlab"),
    ("genre_idx", ("labelled",),
     "SELECT genre, CAST(row_number() OVER (ORDER BY count(*) DESC, genre) - 1 AS DOUBLE) AS genre_index "
     "FROM labelled GROUP BY genre"),
    ("multi", ("labelled", "genre_idx"),
     "SELECT l.*, i.genre_index AS label FROM labelled l JOIN genre_idx i ON l.genre = i.genre"),
    ("scored", ("binlab",),
     f"SELECT track_id, label, "
     f"(CAST(('0x' || substr({h_sql(['track_id'], SCORE_SEED)}, 1, 2))::BIGINT AS DOUBLE) + 64 * label) "
     f"/ 319.0 AS score FROM binlab"),
    ("mscored", ("multi",),
     f"SELECT track_id, label, CASE WHEN lv < 150 THEN label ELSE CAST(lv % 25 AS DOUBLE) END AS prediction "
     f"FROM (SELECT *, ('0x' || substr({h_sql(['track_id'], SCORE_SEED)}, 1, 2))::BIGINT AS lv FROM multi)"),
]

_BY_NAME = {name: (deps, body) for name, deps, body in CTES}
_ORDER = {name: i for i, (name, _, _) in enumerate(CTES)}


def _closure(names) -> list[str]:
    seen: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in seen:
            continue
        seen.add(n)
        stack.extend(_BY_NAME[n][0])
    return sorted(seen, key=_ORDER.get)


def with_ctes(final: str, *names: str) -> str:
    parts = [f"{n} AS ({_BY_NAME[n][1].strip()})" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n" + final


__all__ = ["with_ctes", "u_sql", "h_sql"]
