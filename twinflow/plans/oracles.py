"""SQL with the expected result of each query, for DuckDB over the same tables.

The inputs are the views of ``inputs``; everything after them is written from
the rules and shares no code with the operators.
"""

from twinflow.plans import inputs as I

# DuckDB's epoch_ms rounds, the engine floors.
_MS = "(epoch_us(ts) // 1000)"


def _view(text: str) -> str:
    for name in ("events", "nation", "orders", "region", "customer", "pages"):
        text = text.replace("{" + name + "}", name)
    return text.strip().replace("{ms}", _MS)


_CTES = {
    "m": _view(I.MESSAGES),
    "r0": _view(I.REQUESTS),
    "c": _view(I.CONCEPTS),
    "st": _view(I.STORE),
    "reg": _view(I.REGISTRY),
    "cp": _view(I.CONTEXT_PARAMS),
    "sh": _view(I.SHAPES),
    "u": _view(I.URLS),
    # request fields with the geometry parts as a reader of the JSON sees them
    "r": """
select *, geometry_kind in ('both', 'space') as has_space, geometry_kind in ('both', 'time') as has_time,
       printf('POLYGON((%f %f, %f %f, %f %f, %f %f, %f %f))', min_x, min_y, max_x, min_y,
              max_x, max_y, min_x, max_y, min_x, min_y) as box,
       'EPSG:4326 ' || case wkt_kind
         when 'ok' then printf('POLYGON((%f %f, %f %f, %f %f, %f %f, %f %f))', min_x, min_y, max_x, min_y,
                               max_x, max_y, min_x, max_y, min_x, min_y)
         when 'unclosed' then printf('POLYGON((%f %f, %f %f, %f %f, %f %f))', min_x, min_y, max_x, min_y,
                                     max_x, max_y, min_x, max_y)
         when 'garbage' then printf('POLYGON((%f %f', min_x, min_y) end as full_shape
from r0""",
    "v": """
select *, case when cut then 'malformed_json'
  when coalesce(name, '') = '' then 'missing_name'
  when semantics is null then 'missing_semantics'
  when has_space and wkt_kind = 'missing' then 'missing_shape'
  when has_space and wkt_kind <> 'ok' then 'bad_wkt'
  when has_time and (tstart is null or tstart > 253402300799999) then 'bad_time'
  when has_time and tstart > tend then 'time_reversed'
  when has_time and tunit = 'month' then 'bad_time_unit'
  when has_space <> has_time then 'incomplete_geometry'
  when digital_twin = '' then 'missing_digital_twin'
  when digital_twin = 'not a url' then 'bad_digital_twin' end as first_error
from r""",
    "k": """
select v.*, c.concept_id, c.observable_urn, c.observation_type,
       coalesce(first_error, case when c.urn is null then 'unknown_semantics' end) as error_code
from v left join c on c.urn = v.semantics and not v.cut""",
    "good": "select * from k where error_code is null",
    "routed": """
select request_id, digital_twin, outcome, observation_id, 'success' as route, null as error_code, observation_type
from done
union all
select request_id, case when cut then null else digital_twin end, null,
       case when cut then -1 else observation_id end, 'failure', error_code,
       observation_type
from k where error_code is not null""",
    "d": """
select r0.request_id, semantics, name, digital_twin, observation_id, wkt_kind, cut,
       cast(json_extract(props, '$.k') as bigint) as k,
       case when cut or wkt_kind = 'garbage' then 'malformed_json' when semantics is null then 'missing_urn' end as error
from r0 join events on event_id = request_id""",
}

# documents that bring their observable, checked and submitted the same way
_CTES["rk"] = """
select r.*, r.wkt_kind <> 'missing' as brings,
       coalesce(case when r.wkt_kind <> 'missing' and r.request_id % 2 = 0 then 'PROCESS' end,
                c.observation_type) as observation_type,
       case when cut then 'malformed_json' when coalesce(name, '') = '' then 'missing_name'
            when semantics is null then 'missing_semantics' when digital_twin = '' then 'missing_digital_twin'
            when digital_twin = 'not a url' then 'bad_digital_twin'
            when r.wkt_kind = 'missing' and c.urn is null then 'unknown_semantics' end as error_code
from (select * replace (false as has_space, false as has_time) from r) as r
left join c on c.urn = r.semantics and not r.cut"""
_CTES["rgood"] = "select * from rk where error_code is null"

# one submission over the rows of {p}good
_SUBMISSION = {
    "given": """
select {p}good.*, row_number() over w as nth, first_value({p}good.name) over w as first_name,
       first_value({p}good.semantics) over w as first_urn, first_value({p}good.observation_type) over w as first_type,
       first_value(case when has_space then full_shape end) over w as first_shape,
       first_value(case when has_time then tstart end) over w as first_tstart,
       first_value(case when has_time then tend end) over w as first_tend,
       first_value(has_space) over w as first_space, first_value(has_time) over w as first_time
from {p}good where observation_id <> -1
window w as (partition by digital_twin, observation_id order by request_id)""",
    "top": """
select digital_twin, greatest(max(observation_id), 0) as highest
from (select digital_twin, observation_id from st union all select digital_twin, observation_id from {p}given)
group by 1""",
    "done": """
select g.request_id, g.digital_twin,
       case when st.observation_id is null and g.nth = 1 then 'accepted' else 'existing' end as outcome,
       g.observation_id,
       case when st.observation_id is null then g.first_name else st.name end as name,
       case when st.observation_id is null then g.first_urn else st.urn end as urn,
       case when st.observation_id is null then g.first_type else st.observation_type end as observation_type,
       case when st.observation_id is null then g.first_shape end as shape,
       st.observation_id is null and g.first_space as has_space,
       st.observation_id is null and g.first_time as has_time,
       case when st.observation_id is null then g.first_tstart end as tstart,
       case when st.observation_id is null then g.first_tend end as tend
from {p}given g left join st on st.digital_twin = g.digital_twin and st.observation_id = g.observation_id
union all
select f.request_id, f.digital_twin, 'resolved',
       coalesce({p}top.highest, 0) + row_number() over (partition by f.digital_twin order by f.request_id),
       f.name, f.semantics, f.observation_type, case when has_space then full_shape end,
       has_space, has_time, case when has_time then tstart end, case when has_time then tend end
from {p}good f left join {p}top on {p}top.digital_twin = f.digital_twin where f.observation_id = -1""",
}
for _p in ("", "r"):
    _CTES.update({_p + n: text.replace("{p}", _p) for n, text in _SUBMISSION.items()})

# which views each view needs
_NEEDS = {
    "r": ["r0"],
    "v": ["r"],
    "k": ["v", "c"],
    "good": ["k"],
    "given": ["good"],
    "top": ["given", "st"],
    "done": ["given", "top", "good", "st"],
    "routed": ["done", "k"],
    "d": ["r0"],
    "rk": ["r", "c"],
    "rgood": ["rk"],
    "rgiven": ["rgood"],
    "rtop": ["rgiven", "st"],
    "rdone": ["rgiven", "rtop", "rgood", "st"],
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return ordered


def _sql(views: str, body: str) -> str:
    ctes = ",\n".join(f"{n} as ({_CTES[n].strip()})" for n in _closure(views.split()))
    return f"with {ctes}\n{body.strip()}"


_DETAIL = """case {code} when 'malformed_json' then 'value' when 'missing_name' then 'name'
  when 'missing_semantics' then 'semantics' when 'missing_shape' then 'geometry.space.shape'
  when 'bad_wkt' then 'geometry.space.shape' when 'bad_time' then 'geometry.time'
  when 'time_reversed' then 'geometry.time' when 'bad_time_unit' then 'geometry.time.tunit'
  when 'incomplete_geometry' then 'geometry' when 'missing_digital_twin' then 'digitalTwin'
  when 'bad_digital_twin' then 'digitalTwin' end"""

_SHAPE_TEXT = """
case kind when 'point' then 'POINT(' || pts([[0,0]]) || ')'
  when 'line' then 'LINESTRING(' || pts([[0,0],[1,1]]) || ')'
  when 'same' then 'LINESTRING(' || pts([[0,0],[0,0]]) || ')'
  when 'square' then 'POLYGON((' || pts([[0,0],[1,0],[1,1],[0,1],[0,0]]) || '))'
  when 'bowtie' then 'POLYGON((' || pts([[0,0],[1,1],[1,0],[0,1],[0,0]]) || '))'
  when 'flat' then 'POLYGON((' || pts([[0,0],[1,0],[2,0],[0,0]]) || '))'
  when 'bow' then 'POLYGON((' || pts(list_transform(range(n + 1), lambda i: [i % n, (i % n) * (i % n)])) || '))'
  else 'POLYGON((' || pts(list_transform(range(n + 1), lambda i: [(2 * i) % n, ((2 * i) % n) * ((2 * i) % n)])) || '))'
  end"""


def _points(expr: str) -> str:
    return (
        f"array_to_string(list_transform({expr}, "
        "lambda p: (x0 / 2 + p[1]) || ' ' || (y0 / 2 + p[2])), ', ')"
    )


def _shape_text() -> str:
    """Expand each ``pts(...)`` above."""
    out, rest = "", _SHAPE_TEXT
    while "pts(" in rest:
        head, rest = rest.split("pts(", 1)
        depth, i = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[i], 0)
            i += 1
        out += head + _points(rest[: i - 1])
        rest = rest[i:]
    return out + rest


_URL_OK = "page_id % 6 not in (2, 4)"

ORACLES: dict[str, str] = {
    "parse_requests": _sql(
        "r",
        """
select request_id, cut as malformed,
       case when not cut then name end as name, case when not cut then semantics end as semantics,
       case when not cut then digital_twin end as digital_twin,
       case when cut then -1 else observation_id end as observation_id,
       case when not cut and has_space then full_shape end as shape,
       case when not cut and has_space then '1.km' end as sgrid,
       case when not cut and has_space then 'EPSG:4326' end as proj,
       case when not cut and has_time then tstart end as tstart,
       case when not cut and has_time then tend end as tend,
       case when not cut and has_time then tunit end as tunit,
       case when not cut and has_time then cast(1 as integer) end as tscope
from r""",
    ),
    "validate_requests": _sql(
        "v",
        f"""select request_id, first_error as error_code,
       {_DETAIL.format(code="first_error")} as error_detail from v""",
    ),
    "validate_requests_java": _sql(
        "r",
        """
select request_id, case when cut then 'malformed_json' when name is null then 'missing_name'
  when semantics is null then 'missing_semantics'
  when has_space and wkt_kind = 'missing' then 'missing_shape'
  when has_space and wkt_kind <> 'ok' then 'bad_wkt'
  when has_time and coalesce(tstart, 0) > tend then 'time_reversed'
  when digital_twin = 'not a url' then 'bad_digital_twin' end as error_code
from r""",
    ),
    "validate_requests_python": _sql(
        "r",
        """
select request_id, case when cut then 'malformed_json' when coalesce(name, '') = '' then 'missing_name'
  when semantics is null then 'missing_semantics'
  when geometry_kind = 'both' and wkt_kind = 'missing' then 'missing_shape'
  when geometry_kind = 'both' and wkt_kind <> 'ok' then 'bad_wkt'
  when geometry_kind = 'both' and (tstart is null or tstart > 253402300799999) then 'bad_time'
  when geometry_kind = 'both' and tstart > tend then 'time_reversed'
  when geometry_kind = 'both' and tunit = 'month' then 'bad_time_unit' end as error_code,
  not cut and geometry_kind = 'both' as has_geometry
from r""",
    ),
    "error_counts": _sql(
        "k", "select coalesce(error_code, 'ok') as error_code, count(*) as n from k group by 1"
    ),
    "validate_wkt": _sql("r", "select request_id, wkt_kind, wkt_kind = 'ok' as ok from r"),
    "validate_coords": _sql(
        "sh", "select shape_id, kind, kind in ('point', 'line', 'square', 'bow') as ok from sh"
    ),
    "validate_urls": _sql("u", f"select page_id, {_URL_OK} as ok from u"),
    "normalize_url": """
select page_id, case when page_id % 6 not in (2, 4) then url end as url from pages""",
    "prefix_shape": _sql("r", "select request_id, 'EPSG:4326 ' || box as shape from r"),
    "bbox_to_wkt": _sql("r", "select request_id, box as wkt from r"),
    "coords_to_wkt": _sql("sh", f"select shape_id, {_shape_text()} as wkt from sh"),
    "shape_bbox": _sql(
        "r",
        """
select request_id, case when wkt_kind <> 'missing' then 'EPSG:4326' end as proj,
       case when wkt_kind = 'ok' then min_x end as min_x,
       case when wkt_kind = 'ok' then min_y end as min_y,
       case when wkt_kind = 'ok' then max_x end as max_x,
       case when wkt_kind = 'ok' then max_y end as max_y
from r""",
    ),
    "epoch_millis": f"select event_id, {_MS} as millis from events",
    "apply_defaults": _sql(
        "r",
        """
select request_id,
       case when has_space then substr(full_shape, 11) end as shape,
       case when has_space then '1.km' end as sgrid,
       case when has_space then case when request_id % 5 = 0 then 'EPSG:4326' else 'EPSG:3857' end end as proj,
       case when has_time then tstart end as tstart, case when has_time then tend end as tend,
       case when has_time then case when request_id % 3 = 0 then 'year' else tunit end end as tunit,
       case when has_time then cast(case when request_id % 4 = 0 then 1 else 3 end as integer) end as tscope
from r""",
    ),
    "build_geometry": _sql(
        "r",
        """
select request_id,
       case when has_space then case when request_id % 5 = 0 then 'EPSG:4326 ' else 'EPSG:3857 ' end
                                || substr(full_shape, 11) end as shape,
       case when has_space then '1.km' end as sgrid,
       case when has_space then case when request_id % 5 = 0 then 'EPSG:4326' else 'EPSG:3857' end end as proj,
       case when has_time then tstart end as tstart, case when has_time then tend end as tend,
       case when has_time then case when request_id % 3 = 0 then 'year' else lower(tunit) end end as tunit,
       case when has_time then cast(case when request_id % 4 = 0 then 1 else 3 end as integer) end as tscope
from r""",
    ),
    "default_name": _sql(
        "r0",
        """
select request_id, case when coalesce(name, '') = '' then 'testing-1700000000000' else name end as name from r0""",
    ),
    "id_policy": _sql(
        "r0",
        """
select request_id, observation_id as single, cast(-1 as bigint) as federated,
       case when observation_id = 0 then -1 else observation_id end as python from r0""",
    ),
    "build_observations": _sql(
        "r",
        """
select request_id, digital_twin, observation_id, name, semantics as urn,
       case when has_space then full_shape end as shape, case when has_space then '1.km' end as sgrid,
       case when has_space then 'EPSG:4326' end as proj,
       case when has_time then tstart end as tstart, case when has_time then tend end as tend,
       case when has_time then lower(tunit) end as tunit,
       case when has_time then cast(1 as integer) end as tscope
from r""",
    ),
    "request_payloads": _sql(
        "r",
        """
select request_id, name, semantics, digital_twin, observation_id,
       case when has_space then full_shape end as shape, case when has_time then tstart end as tstart,
       geometry_kind <> 'none' as has_geometry
from r""",
    ),
    "build_requests": f"""
with {"sh as (" + _CTES["sh"].replace("from events", ", ts, user_id from events") + ")"},
t as (select *, case when shape_id % 9 = 0 then '' else 'shape-' || shape_id end as new_name,
             {_MS} as t0, {_MS} + case when shape_id % 13 = 0 then -1000 else 86400000 end as t1 from sh)
select shape_id, new_name as name, 'nation:NATION_' || (user_id % 25) as semantics,
       case when shape_id % 6 = 0 then -1 else shape_id % 6 end as observation_id,
       case when new_name = '' then 'missing_name'
            when shape_id % 10 <> 0 and kind in ('same', 'bowtie', 'flat', 'star') then 'bad_coords'
            when shape_id % 10 <> 0 and t0 > t1 then 'time_reversed' end as error_code,
       case when shape_id % 10 <> 0 then 'EPSG:4326 ' || {_shape_text()} end as shape,
       case when shape_id % 10 <> 0 then '1.km' end as sgrid,
       case when shape_id % 10 <> 0 then 'EPSG:4326' end as proj,
       case when shape_id % 10 <> 0 then t0 end as tstart, case when shape_id % 10 <> 0 then t1 end as tend,
       case when shape_id % 10 <> 0 then 'year' end as tunit,
       case when shape_id % 10 <> 0 then cast(case when shape_id % 4 = 0 then 2 else 1 end as integer) end as tscope
from t""",
    "context_requests": _sql(
        "cp",
        """
select param_id, case when trim(coalesce(name, '')) = '' then 'testing-1700000000000' else name end as name,
       'earth:Terrestrial earth:Region' as semantics,
       case when digital_twin <> '' then 'https' || substr(digital_twin, 6) end as digital_twin,
       cast(-1 as bigint) as observation_id,
       'EPSG:4326 ' || case when min_x is null
         then 'POLYGON((33.796 -7.086, 35.946 -7.086, 35.946 -9.41, 33.796 -9.41, 33.796 -7.086))'
         else printf('POLYGON((%f %f, %f %f, %f %f, %f %f, %f %f))', min_x, min_y, max_x, min_y,
                     max_x, max_y, min_x, max_y, min_x, min_y) end as shape,
       '1.km' as sgrid, 'EPSG:4326' as proj, 1325376000000 as tstart, 1356998400000 as tend,
       'year' as tunit, cast(1 as integer) as tscope, 'earth:Terrestrial earth:Region' as urn_attribute
from cp""",
    ),
    "init_observations": _sql(
        "r",
        """
select request_id, case when not cut then name end as name,
       case when not cut then coalesce(semantics, case when request_id % 2 = 0 then 'x:FromAttribute' end,
                'earth:Terrestrial earth:Region') end as urn,
       case when not cut then coalesce(case when has_space then full_shape end,
         'EPSG:4326 POLYGON((33.796 -7.086, 35.946 -7.086, 35.946 -9.41, 33.796 -9.41, 33.796 -7.086))') end as shape,
       case when not cut then '1.km' end as sgrid, case when not cut then 'EPSG:4326' end as proj,
       case when not cut then coalesce(case when has_time then tstart end, 1325376000000) end as tstart,
       case when not cut then coalesce(case when has_time then tend end, 1356998400000) end as tend,
       case when not cut then coalesce(case when has_time then tunit end, 'year') end as tunit,
       case when not cut then cast(1 as integer) end as tscope
from r""",
    ),
    "extract_urn": _sql(
        "d",
        """
select request_id, case when error is null then semantics end as urn, error as error_code from d""",
    ),
    "resolve_urns": _sql(
        "d c",
        """
select request_id, case when error is null then semantics end as urn, c.resource as resource_urn, c.concept_id,
       c.observable_urn,
       coalesce(error, case when c.urn is null then 'unknown_semantics' end) as error_code,
       case when error is null and c.urn is not null then 'success' else 'failure' end as route,
       c.observable_urn as content_observable, case when c.urn is not null then k end as content_k
from d left join c on error is null and c.urn = semantics""",
    ),
    "split_observation": _sql(
        "d",
        """
select request_id, case when not cut and wkt_kind <> 'missing' then semantics end as observation_urn,
       case when not cut and wkt_kind <> 'missing' then k end as observation_k,
       case when not cut then name end as name, case when not cut then semantics end as semantics,
       case when not cut then digital_twin end as digital_twin,
       case when cut then -1 else observation_id end as observation_id,
       case when cut then 'malformed_json' end as error_code
from d""",
    ),
    "resolve_observables": _sql(
        "k", "select request_id, concept_id, observable_urn, observation_type, error_code from k"
    ),
    "known_twins": _sql(
        "r0 reg",
        "select request_id, digital_twin from r0 where digital_twin in (select dt_url from reg)",
    ),
    "contains_twin": _sql(
        "r0 reg",
        "select request_id, digital_twin, digital_twin in (select dt_url from reg) as known from r0",
    ),
    "new_twins": _sql(
        "r0 reg",
        """
select distinct digital_twin as dt_url from r0
where digital_twin not in ('', 'not a url') and digital_twin not in (select dt_url from reg)""",
    ),
    "lookup_scope": _sql(
        "r0 reg",
        """
select request_id, digital_twin, case when digital_twin = '' then 'user' else scope_kind end as scope_kind
from r0 left join reg on dt_url = digital_twin""",
    ),
    "create_scopes": _sql(
        "r0 reg",
        """
select request_id, digital_twin,
       case when digital_twin <> 'not a url' then coalesce(scope_kind, 'user') end as scope_kind
from r0 left join reg on dt_url = digital_twin""",
    ),
    "register_twins": _sql(
        "r0 reg",
        """
select dt_url, scope_kind from reg union all
select distinct digital_twin, 'user' from r0
where digital_twin not in ('', 'not a url') and digital_twin not in (select dt_url from reg)""",
    ),
    "submit_observations": _sql(
        "done",
        """
select request_id, digital_twin, outcome, observation_id, name, urn, observation_type, shape from done""",
    ),
    "submit_federated": _sql(
        "k st",
        """
, top2 as (select digital_twin, max(observation_id) as highest from st group by 1)
select request_id, 'resolved' as outcome,
       coalesce(highest, 0) + row_number() over (partition by k.digital_twin order by request_id) as observation_id,
       'success' as route
from k left join top2 on top2.digital_twin = k.digital_twin where error_code is null
union all
select request_id, null, -1, 'failure' from k where error_code is not null""",
    ),
    "filter_observations": _sql(
        "good",
        """
select request_id, digital_twin, semantics as urn from good
where semantics in (select concat('nation:NATION_', cast(i as varchar)) from range(20) t(i))
  and digital_twin in ('https://twins.example.org/dt/0', 'https://twins.example.org/dt/2',
                       'https://twins.example.org/dt/3', 'https://twins.example.org/dt/5')
  and geometry_kind = 'both' and min_x <= 20 and max_x >= -20 and min_y <= 10 and max_y >= -20
  and tstart < 1705708800000 and tend > 1704412800000""",
    ),
    "route_requests": _sql(
        "routed",
        "select request_id, digital_twin, outcome, observation_id, route, error_code from routed",
    ),
    "routed_counts": _sql(
        "routed m",
        """
select route, count(*) as n, sum(case when route = 'failure' then 1 else 0 end)::bigint as n_content
from routed group by 1
union all
select 'events', count(*), count(*) from m where payload_class = 'Message'""",
    ),
    "failed_requests": _sql(
        "k",
        """
select request_id, error_code, true as kept, case when not cut then name end as content_name,
       true as no_attributes
from k where error_code is not null""",
    ),
    "success_attributes": _sql(
        "done",
        """
select request_id, cast(observation_id as varchar) as id_attribute, observation_type as type_attribute,
       true as empty from done""",
    ),
    "resolved_payloads": _sql(
        "done",
        """
select request_id, digital_twin, observation_id, name, urn, observation_type, shape,
       case when has_space then '1.km' end as sgrid, case when has_space then 'EPSG:4326' end as proj,
       tstart, tend, case when has_time then 'year' end as tunit,
       case when has_time then cast(1 as integer) end as tscope
from done""",
    ),
    "relay_observations": _sql(
        "rdone",
        """
select request_id, 'success' as route, null as error_code, outcome, observation_id, name, observation_type,
       cast(observation_id as varchar) as id_attribute
from rdone
union all
select request_id, 'failure', error_code, null, null, null, null, null from rk where error_code is not null""",
    ),
    "filter_queues": _sql(
        "m", "select message_id, queue from m where queue in ('Events', 'Errors', 'Status')"
    ),
    "filter_messages": _sql(
        "m",
        """
select message_id, type, class, scope_id, timestamp from m
where type in ('error', 'click') and class in ('Runtime', 'Service') and scope_id in ('dt-1', 'dt-2', 'dt-5')
  and timestamp >= 1704412800000 and timestamp < 1705708800000""",
    ),
    "message_attributes": _sql(
        "m",
        """
select message_id, type as a_type, class as a_class, queue as a_queue,
       cast(timestamp as varchar) as a_timestamp from m""",
    ),
    "relay_messages": _sql(
        "m",
        """
select message_id, payload, '1700000000000' as a_event, timestamp as event_ms, type as a_type,
       class as a_class, queue as a_queue, cast(timestamp as varchar) as a_timestamp
from m where queue in ('Events', 'Errors', 'Status')""",
    ),
    "event_route": _sql(
        "m",
        """
select message_id, 'events' as route, payload as content, type as a_type, class as a_class,
       queue as a_queue, cast(timestamp as varchar) as a_timestamp
from m where payload_class = 'Message'""",
    ),
    "message_rates": _sql(
        "m",
        """
select timestamp // 3600000 * 3600000 as window_start, timestamp // 3600000 * 3600000 + 3600000 as window_end,
       queue, type, count(*) as n
from m group by 1, 2, 3, 4""",
    ),
    "latest_message": _sql(
        "m",
        """
select scope_id, timestamp, message_id, type, class, queue, payload, payload_class from m
qualify row_number() over (partition by scope_id order by timestamp desc, message_id desc) = 1""",
    ),
    "twin_summary": _sql(
        "routed",
        """
select digital_twin, outcome, observation_type, error_code, count(*) as n,
       count(distinct observation_id) as n_observations
from routed group by 1, 2, 3, 4""",
    ),
    "stream_requests": _sql(
        "v",
        """
select request_id, case when not cut then name end as name, case when not cut then semantics end as semantics,
       case when not cut then digital_twin end as digital_twin,
       case when cut then -1 else observation_id end as observation_id, first_error as error_code
from v""",
    ),
    "stream_relay": _sql(
        "m",
        """
select message_id, payload, type as a_type, class as a_class, queue as a_queue,
       cast(timestamp as varchar) as a_timestamp
from m where queue in ('Events', 'Errors', 'Status')""",
    ),
    "stream_fanout": _sql(
        "m",
        """
select listener, message_id, payload from m, (values ('first'), ('second')) as l(listener)""",
    ),
    # messages without a usable time are counted under a null window
    "stream_rates": _sql(
        "m",
        """
select ts // 3600000 * 3600000 as window_start, ts // 3600000 * 3600000 + 3600000 as window_end,
       queue, type, count(*) as n
from (select *, case when message_id % 97 > 0 and message_id % 101 > 0 then timestamp end as ts from m)
group by 1, 2, 3, 4""",
    ),
}
ORACLES["stream_submit"] = ORACLES["route_requests"]
ORACLES["stream_register"] = ORACLES["stream_scopes"] = ORACLES["register_twins"]
ORACLES["stream_fanout_log"] = ORACLES["stream_fanout"]
ORACLES["filter_indexed"] = ORACLES["filter_observations"]
ORACLES["written_routes"] = ORACLES["routed_counts"]
ORACLES["twin_summary_merged"] = _sql(
    "routed",
    """
select digital_twin, outcome, observation_type, error_code, count(*) as n, true as near
from routed group by 1, 2, 3, 4""",
)
ORACLES["stream_landed"] = _sql(
    "routed", "select route, outcome, error_code, count(*) as n from routed group by 1, 2, 3"
)
ORACLES["route_scoped"] = _sql(
    "routed reg",
    """
select case when unknown then 'failure' else route end as route, case when not unknown then outcome end as outcome,
       case when unknown then 'unknown_twin' else error_code end as error_code, count(*) as n
from (select *, error_code is null and digital_twin not in (select dt_url from reg) as unknown from routed)
group by 1, 2, 3""",
)
