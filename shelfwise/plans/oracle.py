"""SQL forms of the views, used to check the registered queries against another engine."""

from __future__ import annotations

from shelfwise.operators.coherence import CATCHALL
from shelfwise.operators.enrich import JUNK_TAG, TAG_BLACKLIST
from shelfwise.operators.splitting import EXCLUDED


def fold(x: str) -> str:
    return rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"


def norm_key(x: str) -> str:
    cut = rf"regexp_replace(lower({fold(x)}), '\b(feat\.?|featuring|ft\.?)\b.*', '', 'g')"
    return rf"regexp_replace(regexp_replace({cut}, '[\(\[][^)\]]*[\)\]]', '', 'g'), '[^a-z0-9]+', '', 'g')"


def norm_place(x: str) -> str:
    return f"regexp_replace(lower({fold(x)}), '[^a-z0-9]+', '', 'g')"


def norm_ws(x: str) -> str:
    return rf"trim(regexp_replace(replace(lower({x}), 'ß', 'ss'), '\s+', ' ', 'g'))"


def round_even(x: str, digits: int = 2) -> str:
    return f"CAST(round_even(CAST({x} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def playlist_name(k: str) -> str:
    return (
        f"(CASE {k} % 10 WHEN 0 THEN 'Backup ' WHEN 1 THEN '2019 mix ' WHEN 2 THEN 'Summer 2021 ' ELSE 'List ' END || {k})"
    )


def catchall(name: str) -> str:
    return f"regexp_matches({name}, '{CATCHALL}')"


def excluded(name: str) -> str:
    return f"regexp_matches({name}, '{EXCLUDED}')"


_BLACK = ", ".join(f"'{t}'" for t in TAG_BLACKLIST)
_TAG = "CASE {w} WHEN 'old' THEN 'seen live' WHEN 'new' THEN '80s' ELSE {w} END"


def usable_tag(tag: str) -> str:
    return f"({tag} NOT IN ({_BLACK}) AND NOT regexp_matches({tag}, '{JUNK_TAG}'))"


def not_blacklisted(tag: str) -> str:
    return f"({tag} NOT IN ({_BLACK}))"


def _tag(w: str) -> str:
    return _TAG.format(w=w)


def _bitrate(n: str) -> str:
    return f"CASE {n} % 5 WHEN 0 THEN 'abc' WHEN 1 THEN '320' WHEN 2 THEN '192.7' WHEN 3 THEN '' ELSE '128' END"


def _degrees(k: str, step: int, turn: int, salt: int) -> str:
    return (
        f"(CASE WHEN {k} % 2 = 1 THEN '-' ELSE '' END || (({k} * {step}) % {turn}) || '.' "
        f"|| lpad(CAST(({k} * {salt}) % 10000 AS VARCHAR), 4, '0'))"
    )


def lat_text(k: str) -> str:
    return _degrees(k, 37, 80, 7919)


def lon_text(k: str) -> str:
    return _degrees(k, 53, 170, 6271)


def geohash(lat: str, lon: str, precision: int = 7) -> str:
    """Interleaved bits of the two cell numbers, five bits to a letter."""
    total = 5 * precision
    lon_bits, lat_bits = (total + 1) // 2, total // 2

    def cell(v: str, low: int, span: int, bits: int) -> str:
        return f"CAST(least(greatest(floor(({v} + {low}) / {span} * {1 << bits}), 0), {(1 << bits) - 1}) AS BIGINT)"

    cells = (cell(lon, 180, 360, lon_bits), cell(lat, 90, 180, lat_bits))
    letters = []
    for start in range(0, total, 5):
        bits = []
        for p in range(start, start + 5):
            shift = (lon_bits, lat_bits)[p % 2] - 1 - p // 2
            bits.append(f"(({cells[p % 2]} >> {shift}) & 1) * {16 >> (p - start)}")
        letters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST({' + '.join(bits)} + 1 AS BIGINT), 1)")
    return "(" + " || ".join(letters) + ")"


_LINES = "lineitem JOIN tparts ON l_partkey = p_partkey"
_ORD = "l_orderkey o1, l_linenumber o2, l_partkey o3, l_suppkey o4"
_K = "(c_custkey // 3)"
_OK = "(o_custkey // 3)"
_TEXT_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"

VIEWS: dict[str, tuple[list[str], str]] = {
    "history": ([], f"""
        SELECT {_TEXT_TIME} ts, CAST(round(value * 1000) AS BIGINT) ms_played, 'user ' || user_id artist,
               event_type album, props->>'$.k' track FROM events"""),
    "plays": (["history"], "SELECT * FROM history WHERE ms_played >= 30000 AND artist IS NOT NULL"),
    "tparts": ([], """
        SELECT *, split_part(p_name, ' ', 1) color,
               p_brand || ', ' || upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] artist,
               p_name || ' ' || p_partkey || CASE p_size % 3 WHEN 0 THEN ' (Live)' WHEN 1 THEN ' - Remastered' ELSE '' END track,
               p_type album FROM part"""),
    "library": (["tparts"], f"""
        SELECT {playlist_name('l_suppkey')} playlist, l_suppkey playlist_id, p_partkey track_id, artist, track, album,
               {_ORD} FROM {_LINES}"""),
    "keyed": (["library"], f"SELECT *, {norm_key('artist')} na, {norm_key('track')} nt FROM library"),
    "files": (["tparts"], f"""
        SELECT 0 o1, 0 o2, p_partkey o3, 0 o4, '/mnt/m/' || p_type || '/' || p_partkey || '.mp3' path, '.mp3' extension,
               upper(artist) artist, p_name || ' ' || p_partkey || ' [Remix] feat. Someone' title, p_type album,
               CAST(p_size * 1000 AS VARCHAR) size_bytes, {_bitrate('p_size')} bitrate_kbps FROM tparts
        UNION ALL
        SELECT 1, 0, doc_id, 0, '/mnt/d/' || source || '/' || doc_id || '.flac', '.flac',
               CASE WHEN quality = 0 THEN '' ELSE lang END, CASE WHEN quality = 0 THEN '' ELSE text END, source,
               CAST(n_chars AS VARCHAR), {_bitrate('doc_id')}
        FROM documents LEFT JOIN (SELECT doc_id, min(quality) quality FROM labels GROUP BY 1) USING (doc_id)"""),
    "kfiles": (["files"], f"SELECT *, {norm_key('artist')} na, {norm_key('title')} nt FROM files"),
    "strong": (["kfiles"], "SELECT * FROM kfiles WHERE na <> '' AND nt <> '' AND NOT regexp_full_match(nt, '[0-9]+')"),
    "dgroups": (["strong"], """
        SELECT na, nt, n_files, row_number() OVER (ORDER BY na, nt) group_id
        FROM (SELECT na, nt, count(*) n_files FROM strong GROUP BY 1, 2 HAVING count(*) > 1)"""),
    "ranked": (["strong", "dgroups"], """
        SELECT group_id, artist, title, row_number() OVER (PARTITION BY group_id ORDER BY
                 coalesce(TRY_CAST(bitrate_kbps AS DOUBLE), 0) DESC, coalesce(TRY_CAST(size_bytes AS DOUBLE), 0) DESC, o1, o2, o3, o4) rank,
               path, bitrate_kbps, size_bytes, extension FROM strong JOIN dgroups USING (na, nt)"""),
    "allrows": (["keyed", "kfiles"], """
        SELECT na, nt, artist, track title, album, 'spotify' origin, 0 source_rank, o1, o2, o3, o4 FROM keyed WHERE na <> '' OR nt <> ''
        UNION ALL
        SELECT na, nt, artist, title, album, 'local', 1, o1, o2, o3, o4 FROM kfiles WHERE na <> '' OR nt <> ''"""),
    "tracks": (["allrows"], """
        SELECT *, 'P6-TRK-' || lpad(CAST(row_number() OVER (ORDER BY source_rank, o1, o2, o3, o4) AS VARCHAR), 6, '0') id
        FROM (SELECT * FROM allrows QUALIFY row_number() OVER (PARTITION BY na, nt ORDER BY source_rank, o1, o2, o3, o4) = 1)"""),
    "playlists": (["library"], f"""
        SELECT 'P6-PLS-' || lpad(CAST(row_number() OVER (ORDER BY o1, o2, o3, o4) AS VARCHAR), 4, '0') id, playlist, s_name theme,
               s_acctbal / 10000.0 energy
        FROM (SELECT * FROM library QUALIFY row_number() OVER (PARTITION BY playlist ORDER BY o1, o2, o3, o4) = 1)
        LEFT JOIN supplier ON {playlist_name('s_suppkey')} = playlist"""),
    "links": (["keyed", "tracks", "playlists"], """
        SELECT DISTINCT p.id playlist_id, t.id track_id FROM keyed k JOIN tracks t USING (na, nt) JOIN playlists p USING (playlist)
        WHERE k.na <> '' OR k.nt <> ''"""),
    "matched": (["kfiles", "tracks"], """
        SELECT f.*, t.id track_id, CASE WHEN t.id IS NULL THEN 'orphan' WHEN t.origin = 'spotify' THEN 'matched_library'
                 WHEN t.o1 = f.o1 AND t.o3 = f.o3 THEN 'created' ELSE 'matched_local' END match_class
        FROM kfiles f LEFT JOIN tracks t ON f.na = t.na AND f.nt = t.nt AND (f.na <> '' OR f.nt <> '')"""),
    "status": (["tracks", "links", "matched"], """
        SELECT t.id, t.artist, t.title, t.album,
               (SELECT count(*) FROM links l WHERE l.track_id = t.id) n_playlists,
               (SELECT count(*) FROM matched f WHERE f.track_id = t.id) n_files,
               (SELECT max(TRY_CAST(trunc(TRY_CAST(f.bitrate_kbps AS DOUBLE)) AS BIGINT)) FROM matched f WHERE f.track_id = t.id) best_bitrate
        FROM tracks t"""),
    "cachetags": ([], f"""
        SELECT norm, name, count, rank FROM (
          SELECT norm, name, count(*) count, row_number() OVER (PARTITION BY norm ORDER BY count(*) DESC, name) rank FROM (
            SELECT unnest([lower(p_brand), split_part(p_name, ' ', 1)]) norm, words FROM (
              SELECT p_brand, p_name, [{_tag("split_part(p_name, ' ', 1)")}, {_tag("split_part(p_name, ' ', 2)")}, {_tag("lower(p_type)")}] words FROM part)),
            unnest(words) w(name)
          GROUP BY norm, name) WHERE rank <= 12"""),
    "names": (["library"], f"""
        SELECT artist, pos, trim(name) name, {norm_ws('name')} norm
        FROM (SELECT DISTINCT artist FROM library), unnest(string_split(artist, ', ')) WITH ORDINALITY u(name, pos) WHERE trim(name) <> ''"""),
    "genres": (["names", "cachetags"], f"""
        SELECT artist, string_agg(name, ', ' ORDER BY r) genres FROM (
          SELECT artist, name, row_number() OVER (PARTITION BY artist ORDER BY w DESC, f) r FROM (
            SELECT artist, t.name, max(count) w, min(n.pos * 1000 + rank) f FROM names n JOIN cachetags t USING (norm)
            WHERE {not_blacklisted('t.name')} GROUP BY artist, t.name)) WHERE r <= 3 GROUP BY artist"""),
    "feat": (["tparts"], """
        SELECT artist, track, p_size > 8 found, p_size / 50.0 energy, (p_retailprice - 900.0) / 100.0 valence, p_size / 100.0 danceability,
               p_retailprice / 1000.0 acousticness, (p_partkey % 97) / 97.0 instrumentalness,
               CASE WHEN p_size > 20 THEN 60 + p_partkey % 120 + 0.25 ELSE p_partkey % 150 END tempo,
               CASE WHEN p_size > 20 THEN (p_size % 12 + 1) || 'A' ELSE '' END camelot,
               CASE WHEN p_size > 20 THEN (p_partkey * 1370) % 600000 END ms,
               CASE WHEN p_size > 20 AND p_size % 2 = 0 THEN 'dark' END mood FROM tparts"""),
    "analysis": (["library", "genres", "feat"], f"""
        SELECT o1, o2, o3, o4, playlist, artist, track, album, coalesce(genres, '') genres, coalesce('N' || n_nationkey, '') country,
               CASE WHEN NOT found THEN '' WHEN mood IS NOT NULL THEN mood
                    WHEN energy >= 0.5 THEN CASE WHEN valence >= 0.4 THEN 'energetic' ELSE 'aggressive' END
                    ELSE CASE WHEN valence >= 0.4 THEN 'chill' ELSE 'melancholic' END END mood,
               {", ".join(f"CASE WHEN found THEN {round_even(c)} END {c}" for c in ("energy", "valence", "danceability", "acousticness", "instrumentalness"))},
               CASE WHEN found AND tempo <> 0 THEN CAST({round_even('tempo', 0)} AS BIGINT) END tempo, camelot,
               CASE WHEN coalesce(ms, 0) = 0 THEN '' ELSE (ms // 60000) || ':' || lpad(CAST((ms % 60000) // 1000 AS VARCHAR), 2, '0') END duration, found
        FROM library JOIN feat USING (artist, track) LEFT JOIN genres USING (artist)
        LEFT JOIN nation ON 'brand#' || (n_nationkey + 1) = lower(split_part(artist, ', ', 1))"""),
    "plrows": (["tparts"], f"""
        SELECT l_suppkey playlist, artist, track, album, {_ORD},
               list_sort(list_distinct(list_filter([{_tag("color")}, {_tag("split_part(p_name, ' ', 2)")}, {_tag("lower(p_type)")}], lambda x: {usable_tag('x')}))) tags,
               CASE WHEN p_size > 5 THEN p_size * p_size * p_size * p_size / 6250000.0 END energy,
               CASE WHEN p_size % 7 <> 0 THEN (p_retailprice - 900.0) / 100.0 END valence FROM {_LINES}"""),
    "tagdf": (["plrows"], "SELECT playlist, tag, count(*) df FROM plrows, unnest(tags) u(tag) GROUP BY 1, 2"),
    "facts": (["plrows"], f"""
        SELECT playlist, {playlist_name('playlist')} name, count(*) n_rows, count(*) FILTER (len(tags) > 0) n_tagged,
               CASE WHEN count(energy) >= 15 THEN avg(energy) END e_mean, {catchall(playlist_name('playlist'))} catchall
        FROM plrows GROUP BY playlist"""),
    "profile": (["tagdf"], """
        SELECT playlist, tag, df, row_number() OVER (PARTITION BY playlist ORDER BY df DESC, tag) rank FROM tagdf QUALIFY rank <= 4"""),
    "parrays": (["profile"], "SELECT playlist, list(tag ORDER BY tag) profile FROM profile GROUP BY 1"),
    "misfits": (["plrows", "parrays"], """
        SELECT r.*, profile FROM plrows r JOIN parrays USING (playlist) WHERE len(tags) > 0 AND NOT list_has_any(tags, profile)"""),
    "zout": (["plrows"], """
        WITH v AS (SELECT * FROM (SELECT playlist, o1, o2, o3, o4, tags, energy e, unnest(['energy', 'valence']) kind,
                     unnest([energy, valence]) value FROM plrows WHERE energy IS NOT NULL) WHERE value IS NOT NULL),
        s AS (SELECT playlist, kind, avg(value) mean, stddev_pop(value) std FROM v GROUP BY ALL HAVING count(*) >= 15 AND stddev_pop(value) >= 0.05)
        SELECT v.*, (value - mean) / std z FROM v JOIN s USING (playlist, kind) WHERE abs((value - mean) / std) > 2.2"""),
    "outliers": (["misfits", "facts", "zout"], """
        SELECT playlist, o1, o2, o3, o4, tags, energy e, 'genre' kind, CAST(NULL AS DOUBLE) value, CAST(NULL AS DOUBLE) z
        FROM misfits JOIN facts USING (playlist) WHERE NOT catchall
        UNION ALL SELECT playlist, o1, o2, o3, o4, tags, e, kind, value, z FROM zout"""),
    "advice": (["outliers", "facts", "tagdf"], """
        WITH i AS (SELECT DISTINCT playlist, tags, e FROM outliers),
        sc AS (SELECT i.playlist, i.tags, i.e, f.playlist tgt,
                 CAST(sum(df) AS BIGINT) / greatest(n_tagged, 1) * coalesce(1 - 0.5::DOUBLE * abs(i.e - e_mean), 1) score
               FROM i, unnest(i.tags) u(tag) JOIN tagdf d ON d.tag = u.tag JOIN facts f ON f.playlist = d.playlist
               WHERE NOT f.catchall AND f.playlist <> i.playlist GROUP BY i.playlist, i.tags, i.e, f.playlist, n_tagged, e_mean)
        SELECT playlist, tags, e, tgt, score FROM sc WHERE score >= 0.3
        QUALIFY row_number() OVER (PARTITION BY playlist, tags, e ORDER BY score DESC, tgt) = 1"""),
    "large": (["plrows"], f"""
        SELECT playlist, {playlist_name('playlist')} name, count(*) n FROM plrows GROUP BY 1
        HAVING count(*) >= 120 AND NOT {excluded(playlist_name('playlist'))}"""),
    "cands": (["large", "tagdf"], """
        SELECT playlist, tag, row_number() OVER (PARTITION BY playlist ORDER BY df DESC, tag) rank FROM tagdf JOIN large USING (playlist)
        WHERE df <= 0.6::DOUBLE * n AND df >= greatest(12::DOUBLE, 0.08::DOUBLE * n) QUALIFY rank <= 8"""),
    "dest": (["plrows", "large", "cands"], """
        SELECT r.*, name, n, coalesce(d.tag, 'divers') dest FROM plrows r JOIN large USING (playlist)
        LEFT JOIN (SELECT p.playlist, o1, o2, o3, o4, arg_min(c.tag, rank) tag FROM plrows p, unnest(p.tags) u(t)
                   JOIN cands c ON c.playlist = p.playlist AND c.tag = u.t GROUP BY p.playlist, o1, o2, o3, o4) d USING (playlist, o1, o2, o3, o4)"""),
    "detail": (["dest"], """
        WITH s AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY playlist, dest) < 12 THEN 'divers' ELSE dest END theme FROM dest),
        r AS (SELECT *, row_number() OVER (PARTITION BY playlist, theme ORDER BY energy ASC NULLS LAST, o1, o2, o3, o4) position,
                count(*) OVER (PARTITION BY playlist, theme) theme_rows FROM s)
        SELECT *, (position - 1) // 37 + 1 volume, name || ' — ' || theme || CASE WHEN theme_rows > 37 THEN ' (Vol. ' || ((position - 1) // 37 + 1) || ')' ELSE '' END sub_playlist
        FROM r"""),
    "maps": ([], f"""
        SELECT '/maps/' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '.kml' path, 'Map ' || c_nationkey AS map,
               lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '.kml' source_file, ascii(c_mktsegment) layer_pos,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END layer, c_custkey pos,
               CASE WHEN c_custkey % 13 = 5 THEN '' ELSE 'Café No. ' || {_K} END AS name,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE 'note ' || c_custkey END description,
               CASE WHEN c_custkey % 11 = 0 THEN 'LineString' ELSE 'Point' END geometry,
               CAST({lat_text(_K)} AS DOUBLE) lat, CAST({lon_text(_K)} AS DOUBLE) lon FROM customer"""),
    "saved": ([], f"""
        SELECT *, CASE WHEN shape IN (1, 2) THEN CAST({lat_text('k')} AS DOUBLE) END lat, CASE WHEN shape IN (1, 2) THEN CAST({lon_text('k')} AS DOUBLE) END lon,
               CASE WHEN shape IN (0, 2) THEN '0x' || k || ':0x' || (k * 7 + 1) END cid,
               CASE shape WHEN 0 THEN 'https://maps.example.org/place/x/data=!1s0x' || k || ':0x' || (k * 7 + 1)
                 WHEN 1 THEN 'https://maps.example.org/search/' || {lat_text('k')} || ',+' || {lon_text('k')}
                 WHEN 2 THEN 'https://maps.example.org/place/x/@' || {lat_text('k')} || ',' || {lon_text('k')} || ',17z/data=!1s0x' || k || ':0x' || (k * 7 + 1)
                 ELSE 'https://maps.example.org/s/short' END url
        FROM (SELECT '/lists/' || o_orderpriority || '.csv' path, o_orderpriority || '.csv' source_file, o_orderpriority list, o_orderkey pos, {_OK} k,
                o_orderkey % 4 shape, 'Café No. ' || {_OK} title, CASE WHEN o_orderkey % 3 = 0 THEN 'n' || o_orderkey END note, o_orderstatus tags,
                CASE WHEN o_orderkey % 5 = 0 THEN 'seen' END comment FROM orders)"""),
    "occ": (["maps", "saved"], f"""
        SELECT row_number() OVER (ORDER BY src, path, part, row) o, * FROM (
          SELECT 0 src, path, layer_pos part, pos AS row, name, lat, lon, CAST(NULL AS VARCHAR) reference, description, CAST(NULL AS VARCHAR) url, 'my_maps' origin,
                 source_file, 'my_maps:' || map || '/' || CASE WHEN layer = '' THEN '(sans calque)' ELSE layer END list_key, description note, CAST(NULL AS VARCHAR) tags,
                 'geo:' || {norm_place('name')} || '|' || {geohash('lat', 'lon')} k1, CAST(NULL AS VARCHAR) k2 FROM maps WHERE geometry = 'Point'
          UNION ALL
          SELECT 1, path, 0, pos, title, lat, lon, cid, NULL, url, 'saved', source_file, 'saved:/' || list, nullif(concat_ws(' — ', note, comment), ''), tags,
                 CASE shape WHEN 0 THEN 'cid:' || cid WHEN 2 THEN 'cid:' || cid WHEN 1 THEN 'geo:' || {norm_place('title')} || '|' || {geohash('lat', 'lon')}
                   ELSE 'raw:' || {norm_place('title')} || '|saved:' || list END,
                 CASE WHEN shape = 2 THEN 'geo:' || {norm_place('title')} || '|' || {geohash('lat', 'lon')} END FROM saved)"""),
    "keyparent": (["occ"], """
        WITH f AS (SELECT key, min(o) first FROM (SELECT o, k1 key FROM occ UNION ALL SELECT o, k2 FROM occ WHERE k2 IS NOT NULL) GROUP BY key)
        SELECT f.key, f.first, CASE WHEN a.first < f.first THEN occ.k1 WHEN b.first < f.first THEN occ.k2 ELSE occ.k1 END parent
        FROM f JOIN occ ON occ.o = f.first JOIN f a ON a.key = occ.k1 LEFT JOIN f b ON b.key = occ.k2"""),
    "keyroot": (["keyparent"], """
        WITH RECURSIVE w AS (SELECT key, first, parent FROM keyparent
          UNION ALL SELECT w.key, w.first, p.parent FROM w JOIN keyparent p ON p.key = w.parent WHERE p.parent <> w.parent)
        SELECT w.key, w.parent root FROM w JOIN keyparent p ON p.key = w.parent WHERE p.parent = p.key"""),
    "keyids": (["keyroot", "keyparent"], """
        SELECT r.key, id, r.key = r.root is_new FROM keyroot r JOIN (
          SELECT key root, 'P6-PLC-' || CASE WHEN n < 1000000 THEN lpad(CAST(n AS VARCHAR), 6, '0') ELSE CAST(n AS VARCHAR) END id
          FROM (SELECT key, row_number() OVER (ORDER BY first) n FROM keyparent WHERE key = parent)) USING (root)"""),
    "occids": (["occ", "keyids"], "SELECT occ.*, id FROM occ JOIN keyids ON key = k1"),
    "places": (["occids"], f"""
        SELECT id, coalesce(nullif(name, ''), '(sans nom)') AS name, {norm_place('name')} norm_name, lat, lon,
               CASE WHEN lat IS NOT NULL THEN {geohash('lat', 'lon')} END geohash, description, url, 'VALIDATED' status, origin, source_file
        FROM occids QUALIFY row_number() OVER (PARTITION BY id ORDER BY o) = 1"""),
    "plists": (["maps", "saved"], """
        SELECT *, 'P6-PLL-' || lpad(CAST(row_number() OVER (ORDER BY src, path, part) AS VARCHAR), 4, '0') id FROM (
          SELECT DISTINCT 0 src, path, layer_pos part, CASE WHEN layer = '' THEN '(sans calque)' ELSE layer END AS name, map map_name, 'my_maps' AS type, source_file,
                 'my_maps:' || map || '/' || CASE WHEN layer = '' THEN '(sans calque)' ELSE layer END list_key FROM maps
          UNION ALL SELECT DISTINCT 1, path, 0, list, NULL, 'saved', source_file, 'saved:/' || list FROM saved)"""),
    "lplaces": (["occids", "plists"], """
        SELECT l.id list_id, o.id place_id, note, tags FROM occids o JOIN plists l USING (list_key)
        QUALIFY row_number() OVER (PARTITION BY l.id, o.id ORDER BY o.o) = 1"""),
    "prefs": (["occids"], """
        SELECT id place_id, 'google' platform, reference external_id FROM occids WHERE reference IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY o) = 1"""),
    "pagerows": ([], r"""
        SELECT CAST(conv_id AS VARCHAR) unit, conv_id, page_offset, role, pos - 1 pos, CASE WHEN role = 'system' THEN '' ELSE line END track
        FROM (SELECT *, (SELECT coalesce(sum(len(string_split(text, chr(10)))), 0)::BIGINT FROM conversations b WHERE b.conv_id = c.conv_id AND b.turn < c.turn)
              AS page_offset FROM conversations c), unnest(string_split(text, chr(10))) WITH ORDINALITY u(line, pos)"""),
    "listing": ([], """
        SELECT DISTINCT CAST(conv_id AS VARCHAR) unit, 2 * conv_id AS ordinal, NULL::BIGINT AS total FROM conversations
        UNION ALL SELECT DISTINCT 'x' || conv_id, 2 * conv_id + 1, CASE WHEN conv_id % 20 = 7 THEN 0 END FROM conversations WHERE conv_id % 10 = 7"""),
    "pagefacts": (["pagerows"], r"""
        SELECT p.unit, p.conv_id, p.page_offset, count(*) n_items,
               CASE WHEN p.page_offset < (SELECT max(page_offset) FROM pagerows m WHERE m.conv_id = p.conv_id)
                         OR (p.role = 'user' AND p.conv_id % 9 = 8) THEN 'more' END next
        FROM pagerows p WHERE p.role <> 'system' GROUP BY ALL"""),
    # Following the pages one by one from offset 0, as a client would.
    "progress": (["pagefacts", "listing"], """
        SELECT l.unit, l.ordinal, coalesce(max(o), 0)::BIGINT AS "offset", coalesce(bool_or(finished), false) OR coalesce(any_value(l.total) = 0, false) AS done
        FROM listing l LEFT JOIN (
          WITH RECURSIVE walk(unit, o, finished) AS (
            SELECT unit, n_items, next IS NULL FROM pagefacts WHERE page_offset = 0
            UNION ALL SELECT f.unit, w.o + f.n_items, f.next IS NULL FROM walk w JOIN pagefacts f ON f.unit = w.unit AND f.page_offset = w.o)
          SELECT * FROM walk) k ON k.unit = l.unit GROUP BY l.unit, l.ordinal"""),
    "recordings": (["tparts"], f"""
        SELECT '/x/' || o_orderkey || '.mp3' path, o_orderstatus, score, p_brand || ', ' || color artist, p_name title,
               CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'EP ' || p_type END album, CAST(p_partkey AS VARCHAR) mbid
        FROM orders LEFT JOIN (SELECT *, 1.0::DOUBLE - 3.0::DOUBLE * l_discount score FROM {_LINES} WHERE p_size > 4) ON l_orderkey = o_orderkey
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY score DESC NULLS LAST, l_linenumber, l_partkey, l_suppkey) = 1"""),
    "identified": (["recordings"], f"""
        SELECT path, status, CASE WHEN s THEN r END score, CASE WHEN s THEN artist END artist, CASE WHEN s THEN title END title,
               CASE WHEN s THEN album END album, CASE WHEN s THEN mbid END mbid
        FROM (SELECT *, {round_even('score', 3)} r, CASE WHEN o_orderstatus = 'F' THEN 'error' WHEN score IS NULL THEN 'nomatch'
                WHEN {round_even('score', 3)} < 0.8 THEN 'low_score' ELSE 'ok' END status, status IN ('ok', 'low_score') s FROM recordings)"""),
    "plan": (["identified"], """
        SELECT path, coalesce(c_name, '') old_artist, coalesce(o_orderpriority, '') old_title, coalesce(artist, '') new_artist, coalesce(title, '') new_title,
               coalesce(album, '') new_album, score, coalesce(mbid, '') mbid, status
        FROM identified LEFT JOIN (orders JOIN customer ON c_custkey = o_custkey) ON path = '/x/' || o_orderkey || '.mp3'"""),
    "snaps": ([], """
        SELECT event_type stream, run, CAST(floor(100 * sum(n) OVER (PARTITION BY event_type ORDER BY run) / sum(n) OVER (PARTITION BY event_type)) AS BIGINT) pct
        FROM (SELECT event_type, dayofmonth(ts) run, count(*) n FROM events GROUP BY 1, 2)"""),
}


def sql(body: str, *views: str) -> str:
    """``body`` preceded by the views it reads, each after the views it is built on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in VIEWS[name][0]:
                add(needed)
            ordered.append(name)

    for view in views:
        add(view)
    if not ordered:
        return body
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered) + " " + body
