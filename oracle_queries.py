"""The registered queries as DuckDB SQL, from the definitions: parameters are lists and tables.

``CTE`` holds named sub-queries; ``sql(body)`` puts the ones a body needs in front of it.
"""

from __future__ import annotations

import re

from ballotlake import schemas

CTE: dict[str, str] = {}

# --- inputs --------------------------------------------------------------------------------------
CTE["base"] = """
select c_custkey as k, c_custkey::varchar as source_id, 'F' || (c_custkey % 97) as first_name,
  'L' || (c_custkey % 89) as last_name, (16 + (c_custkey * 31) % 80)::int as age,
  case when c_custkey % 53 = 0 then null when c_custkey % 2 = 0 then 'M' else 'F' end as gender,
  case when c_custkey % 41 = 0 then 'XXX' else
    ['AL','AZ','CA','CO','FL','GA','IL','IN','IA','MA','MD','MI','MN','MO','NC','NJ','NV','NY','OH',
     'OR','PA','TX','VA','WA','WI'][c_nationkey + 1] end as state,
  case when c_custkey % 11 = 0 then 'Green'
    when c_mktsegment in ('AUTOMOBILE', 'MACHINERY') then 'Democrat'
    when c_mktsegment in ('BUILDING', 'FURNITURE') then 'Republican' else 'Independent' end as party,
  case when c_custkey % 29 = 0 then 'no-at-sign' else 'Voter' || c_custkey || '@Example.COM' end as email,
  date '1985-01-01' + ((c_custkey * 7919) % 12000)::int as registered_date,
  (select max(date '2005-06-01' + (3 * (o_orderdate::date - date '1995-01-01'))::int)
   from orders where o_custkey = c_custkey and o_orderstatus = 'F'
     and o_orderkey % (1 + o_custkey % 5) = 0) as last_voted_date
from customer"""
CTE["raw"] = """
select * exclude (k) from base
union all select * exclude (k) from base where k % 13 = 0
union all select * exclude (k) replace ((registered_date + 30)::date as last_voted_date) from base where k % 17 = 0"""
CTE["earlier"] = "select * from raw where last_voted_date is null or last_voted_date < date '2012-01-01'"
CTE["later"] = "select * from raw where last_voted_date >= date '2012-01-01'"

CTE["results"] = """
select (1976 + 4 * (o_orderkey % 12))::int as year,
  ['AL','AZ','CA','CO','FL','GA','IL','IN','IA','MA','MD','MI','MN','MO','NC','NJ','NV','NY','OH',
   'OR','PA','TX','VA','WA','WI'][c_nationkey + 1] as state_po,
  'CAND ' || (o_orderkey % 5) as candidate,
  case o_orderkey % 5 when 0 then 'DEMOCRAT' when 1 then 'REPUBLICAN' when 2 then 'LIBERTARIAN' else 'OTHER' end
    as party_simplified,
  floor(o_totalprice / 1000)::int as candidatevotes, (3 * floor(o_totalprice / 1000))::int as totalvotes,
  o_orderkey as seq
from orders join customer on c_custkey = o_custkey"""
CTE["civic"] = """
select o_orderkey::varchar as id, o_orderkey as seq,
  n_name || ' ' || (2023 + o_orderkey % 5) || ' ' ||
    ['Presidential Primary','Special Senate Election','Governor General Election','County Election',
     'House Election in CA','City Council Election','State Legislature Election','Runoff'][o_orderkey % 8 + 1] as name,
  strftime(make_date(2023 + o_orderkey % 5, month(o_orderdate), least(day(o_orderdate), 28)), '%Y-%m-%d')
    || 'T00:00:00Z' as "electionDay"
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey"""


# --- voter models --------------------------------------------------------------------------------
VERSION = ("first_name", "last_name", "age", "gender", "state", "party", "email", "registered_date", "last_voted_date")


def dim(raw: str, as_of: str) -> str:
    """All versions of an id as a list of distinct structs; an id with one element is a voter."""
    packed = ", ".join(f"{c} := {c}" for c in VERSION)
    return f"""
select source_id, v.*, date '{as_of}' as inserted_date, date '{as_of}' as last_modified_date
from (select source_id, unnest(known) as v
  from (select source_id, list(distinct struct_pack({packed})) as known
    from (select * replace (if(contains(email, '@'), lower(email), null) as email) from {raw}) group by source_id)
  where len(known) = 1 and source_id is not null)
where not (v.age is null or v.gender is null or v.email is null or v.registered_date is null)
  and len(v.state) = 2 and list_contains(['Democrat', 'Republican', 'Independent'], v.party)"""


# Labels from a lower bound on; the highest bound that fits decides.
CTE["age_bands"] = "select unnest([18, 30, 50, 65]) as low, unnest(['18-29', '30-49', '50-64', '65+']) as label"
CTE["lapse_bands"] = """
select unnest([0, 1, 2, 4, 7]) as low, unnest(['Current Voter', 'Missed Last Election', 'Occasional Voter',
  'Infrequent Voter', 'Dormant Voter']) as label"""


def stage(dim_rows: str, as_of: str, processed: str) -> str:
    return f"""
select source_id as voter_id, (select arg_max(label, low) from age_bands where low <= age) as age_group,
  gender, state, party, registered_date, (date '{as_of}' - registered_date)::int as days_since_registered,
  ({as_of[:4]} - year(registered_date))::int as years_since_registered, last_voted_date, elections_since_last_vote,
  coalesce((select arg_max(label, low) from lapse_bands where low <= elections_since_last_vote), 'Never Voted')
    as voter_engagement_segment,
  ['Presidential Year', 'Off-Year/Primary', 'Midterm Year', 'Off-Year/Primary'][year(last_voted_date) % 4 + 1]
    as last_vote_cycle_type,
  timestamp '{processed}' as last_processed_date
from (select *, if(last_voted_date is null, null,
    (select count(*) from cycles where election_date > last_voted_date))::int as elections_since_last_vote
  from {dim_rows} where age >= 18)"""


def upsert(target: str, updates: str, key: str) -> str:
    return f"""
select * from {target} where {key} not in (select {key} from {updates}) union all by name select * from {updates}"""


CTE["dim"] = dim("raw", "2025-06-30")
CTE["stage"] = stage("dim", "2025-06-30", "2025-06-30 00:00:00")
CTE["first_dim"] = dim("earlier", "2025-06-29")
CTE["second_dim"] = upsert("first_dim", "dim", "source_id")
CTE["first_stage"] = stage("first_dim", "2025-06-29", "2025-06-29 12:00:00")
CTE["young_dim"] = """
select * from second_dim
where greatest(inserted_date, last_modified_date) > (select max(last_processed_date) from first_stage)"""
CTE["new_stage"] = stage("young_dim", "2025-06-30", "2025-06-30 12:00:00")

GROUPS = "state, age_group, gender, party"


def tally(parts: dict[str, str]) -> str:
    """Rows for which each condition holds, as columns."""
    return ", ".join(f"sum(if({condition}, 1, 0))::bigint as {name}" for name, condition in parts.items())


def shares(parts: dict[str, str], whole: str) -> str:
    """Percentages of the whole with two digits, as columns."""
    return ", ".join(f"round(100.0 * {part} / {whole}, 2)::double as {name}" for name, part in parts.items())


def mean(column: str, name: str) -> str:
    return f"avg({column})::double as {name}"


def in_segment(*names: str) -> str:
    return f"voter_engagement_segment in ({', '.join(repr(n) for n in names)})"


MISSED = "elections_since_last_vote"
ENGAGED = {
    "current_voters": in_segment("Current Voter"), "missed_last_voters": in_segment("Missed Last Election"),
    "occasional_voters": in_segment("Occasional Voter"), "infrequent_voters": in_segment("Infrequent Voter"),
    "dormant_voters": in_segment("Dormant Voter"), "never_voted": in_segment("Never Voted"),
    "targetable_voters": f"{MISSED} >= 2", "high_opportunity_voters": f"{MISSED} >= 4",
}
CTE["snapshot"] = f"""
select *, {shares({f'pct_{c}': c for c in ENGAGED}, 'total_voters')}, date '2025-06-30' as snapshot_date
from (select {GROUPS}, voter_engagement_segment, last_vote_cycle_type, count(distinct voter_id)::bigint as total_voters,
  {mean('years_since_registered', 'avg_years_registered')},
  median(years_since_registered)::double as median_years_registered, {mean(MISSED, 'avg_elections_missed')},
  {tally(ENGAGED)} from stage group by all)"""

CTE["cycles"] = """
select year::int as election_year, kind as election_type, day::date as election_date from (values
  (2008, 'Presidential', '2008-11-04'), (2010, 'Midterm', '2010-11-02'), (2012, 'Presidential', '2012-11-06'),
  (2014, 'Midterm', '2014-11-04'), (2016, 'Presidential', '2016-11-08'), (2018, 'Midterm', '2018-11-06'),
  (2020, 'Presidential', '2020-11-03'), (2022, 'Midterm', '2022-11-08'), (2024, 'Presidential', '2024-11-05')
) as t(year, kind, day)"""
CYCLE = "election_year, election_type, election_date"
# One row per voter and cycle: the cycles travel with every voter as a list.
CTE["eligibility"] = f"""
select voter_id, {GROUPS}, registered_date, cycle.election_date, cycle.election_type, cycle.election_year,
  (registered_date <= cycle.election_date)::int as was_registered,
  coalesce(registered_date <= cycle.election_date and abs(last_voted_date - cycle.election_date) <= 90, false)::int
    as likely_voted
from (select *, unnest((select list(c) from cycles c)) as cycle from stage)"""
CTE["tallies"] = f"""
select {CYCLE}, {GROUPS}, sum(was_registered)::bigint as eligible_voters, sum(likely_voted)::bigint as estimated_voters
from eligibility group by all"""
CTE["demo"] = f"""
select {CYCLE}, state, age_group, gender, sum(eligible_voters)::bigint as demo_eligible_total,
  sum(estimated_voters)::bigint as demo_voted_total from tallies group by all"""
CTE["by_party"] = "select * from tallies where eligible_voters > 0"
CTE["rates"] = f"""
select *, {", ".join(
    f"coalesce(round(100.0 * {part} / nullif({whole}, 0), 2), 0.0)::double as {name}"
    for name, part, whole in (
        ("participation_rate", "estimated_voters", "eligible_voters"),
        ("pct_of_eligible_by_demo", "eligible_voters", "sum(eligible_voters) over everyone"),
        ("pct_of_voters_by_demo", "estimated_voters", "sum(estimated_voters) over everyone")))}
from by_party window everyone as (partition by {CYCLE}, state, age_group, gender)"""
# The previous cycle of the same type is the entry before in the group's list of cycles.
CTE["trends"] = f"""
select * exclude (before), before.eligible_voters as prev_eligible_voters,
  before.participation_rate as prev_participation_rate,
  if(before.eligible_voters > 0, round(100.0 * (eligible_voters - before.eligible_voters) / before.eligible_voters, 2),
    null)::double as eligible_voter_change_pct,
  round(participation_rate - before.participation_rate, 2)::double as participation_rate_change_pts
from (select r.*, (select arg_max(b, b.election_year) from rates b
    where b.election_year < r.election_year and b.election_type = r.election_type
      and (b.state, b.age_group, b.gender, b.party) is not distinct from (r.state, r.age_group, r.gender, r.party)) as before
  from rates r)"""

LAPSE = {
    "active_voters": (0, 0), "lapsed_1_election": (1, 1), "lapsed_2_3_elections": (2, 3), "lapsed_4_6_elections": (4, 6),
    "dormant_voters": (7, 99), "prime_target_voters": (1, 3), "broad_target_voters": (2, 6),
}
CTE["segments"] = f"""
select {GROUPS}, count(distinct voter_id)::bigint as total_voters,
  {tally({name: f'{MISSED} between {low} and {high}' for name, (low, high) in LAPSE.items()})},
  {tally({'never_voted': f'{MISSED} is null'})},
  {mean(MISSED, 'avg_elections_missed')}, {mean('years_since_registered', 'avg_registration_tenure')}
from stage group by all"""
CTE["tiers"] = """
select * from (values (1, 'High Priority', 25, 5), (2, 'Medium Priority', 15, 3), (3, 'Low Priority', 8, 2),
  (4, 'Monitor Only', 0, 0)) as t(place, label, lowest, fewest)"""
# Weight, value and base of every part of the score; small segments have none.
SCORE = """[{w: 40.0::double, v: lapsed_1_election::double, b: total_voters::double},
  {w: 30.0::double, v: (lapsed_2_3_elections + lapsed_4_6_elections)::double, b: total_voters::double},
  {w: 20.0::double, v: least(avg_registration_tenure / 10.0::double, 1.0::double), b: 1.0::double},
  {w: 10.0::double, v: least(total_voters / 1000.0::double, 1.0::double), b: 1.0::double}]"""
CTE["scored"] = f"""
select *, {shares({
    'pct_prime_targets': 'prime_target_voters', 'pct_broad_targets': 'broad_target_voters',
    'pct_recently_lapsed': 'lapsed_1_election', 'pct_dormant': 'dormant_voters', 'pct_never_voted': 'never_voted',
    'pct_medium_lapsed': '(lapsed_2_3_elections + lapsed_4_6_elections)', 'pct_active_voters': 'active_voters',
}, 'total_voters')},
  round(if(total_voters < 3, 0.0, list_sum(list_transform({SCORE}, lambda p: p.w * p.v / p.b)))::double, 2)::double
    as opportunity_score
from segments"""
CTE["targeting"] = f"""
select *, (row_number() over (partition by state order by national_rank))::int as state_rank
from (select *, (row_number() over (order by opportunity_score desc, total_voters desc, {GROUPS}))::int as national_rank,
  (select arg_min(label, place) from tiers where opportunity_score >= lowest and total_voters >= fewest)
    as targeting_tier, date '2025-06-30' as analysis_date from scored)"""

STATE_PARTS = {
    "democrat_voters": "party = 'Democrat'", "republican_voters": "party = 'Republican'",
    "independent_voters": "party = 'Independent'", "n_18_29": "age_group = '18-29'", "n_30_49": "age_group = '30-49'",
    "n_50_64": "age_group = '50-64'", "n_65_plus": "age_group = '65+'", "n_female": "gender = 'F'", "n_male": "gender = 'M'",
    "current_voters": in_segment("Current Voter"),
    "recoverable_voters": in_segment("Missed Last Election", "Occasional Voter"),
    "disengaged_voters": in_segment("Infrequent Voter", "Dormant Voter"), "n_never": in_segment("Never Voted"),
}
STATE_SHARES = {
    "pct_democrat": "democrat_voters", "pct_republican": "republican_voters", "pct_independent": "independent_voters",
    "pct_18_29": "n_18_29", "pct_30_49": "n_30_49", "pct_50_64": "n_50_64", "pct_65_plus": "n_65_plus",
    "pct_female": "n_female", "pct_male": "n_male", "pct_current_voters": "current_voters",
    "pct_recoverable_voters": "recoverable_voters", "pct_disengaged_voters": "disengaged_voters", "pct_never_voted": "n_never",
}
CTE["states"] = f"""
select *, {shares(STATE_SHARES, 'total_registered_voters')}
from (select state, count(distinct voter_id)::bigint as total_registered_voters, {tally(STATE_PARTS)},
  round(avg({MISSED}), 2)::double as avg_elections_missed,
  round(avg(years_since_registered), 1)::double as avg_years_registered,
  round(median(years_since_registered), 1)::double as median_years_registered
from stage group by state)"""
CTE["closeness"] = "select unnest([5, 15]) as gap, unnest(['Highly Competitive', 'Competitive']) as label"
CTE["summary"] = """
select * exclude (n_18_29, n_30_49, n_50_64, n_65_plus, n_female, n_male, n_never),
  round(list_sum(list_transform(list_zip([0.6::double, 0.3::double, 0.1::double],
    [pct_recoverable_voters, pct_disengaged_voters, pct_never_voted]), lambda p: p[1] * p[2])), 2)::double
    as engagement_opportunity_score,
  coalesce((select arg_min(label, gap) from closeness where abs(pct_democrat - pct_republican) <= gap),
    'Lean ' || if(pct_democrat > pct_republican, 'Democrat', 'Republican')) as partisan_lean,
  date '2025-06-30' as summary_date
from states"""

# --- ingest --------------------------------------------------------------------------------------
HASH = "md5(concat_ws('|', " + ", ".join(
    f"lower(trim(coalesce({c}, '')))" for c in ("source_id", "first_name", "last_name", "email")) + "))"
CTE["hashed"] = f"select *, {HASH} as record_hash from raw"
CTE["filed"] = """
select *, coalesce(year(last_voted_date) // 5, 0)::int as file_number from hashed"""
CTE["ingested"] = """
select * exclude (first_file) from (select *, min(file_number) over (partition by record_hash) as first_file from filed)
where file_number = first_file"""
STAMPED = """source_id, first_name, last_name, age, gender, state, party, email, registered_date, last_voted_date,
  'voters_' || file_number || '.csv' as source_file, record_hash, timestamp '2025-06-30 00:00:00' as inserted_at,
  timestamp '2025-06-30 00:00:00' as updated_at"""
CTE["texts"] = """
select source_id as id, case when k % 10 = 0 then 'nan' when k % 43 = 0 then first_name || ', the' || chr(10) || '"second"'
    when k % 3 = 0 then '  ' || first_name || ' ' else first_name end as first_name,
  case when k % 19 = 0 then 'N/A' else last_name end as last_name,
  case when k % 23 = 0 then 'x' when k % 4 = 0 then age || '.0' else age::varchar end as age, gender, state,
  case when k % 7 = 0 then party || chr(9) else party end as party, email,
  case when k % 31 = 0 then strftime(registered_date, '%Y/%m/%d') else strftime(registered_date, '%Y-%m-%d') end
    as registered_date,
  case when k % 37 = 0 then '2020-02-30' when k % 5 = 0 then strftime(last_voted_date, '%Y-%m-%dT23:15:00')
    else strftime(last_voted_date, '%Y-%m-%d') end as last_voted_date
from (select source_id::bigint as k, * from raw)"""


def _text(column: str) -> str:
    na = "''" + "".join(f", '{t}'" for t in ("nan", "None", "NaN", "none", "N/A", "NA", "NULL", "null"))
    blanks = "' ' || chr(9) || chr(10) || chr(13)"
    return f"case when trim({column}, {blanks}) not in ({na}) then trim({column}, {blanks}) end as {column}"


def _date(column: str) -> str:
    return (f"case when regexp_matches({column}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(T[0-9:]+)?$') "
            f"then try_cast(left({column}, 10) as date) end as {column}")


CLEANED = f"""select id, {_text('first_name')}, {_text('last_name')}, try_cast(try_cast(age as double) as int) as age,
  {_text('gender')}, {_text('state')}, {_text('party')}, {_text('email')}, {_date('registered_date')},
  {_date('last_voted_date')} from texts"""

# --- elections -----------------------------------------------------------------------------------


def tuesday(year: str, month: int) -> str:
    first = f"make_date({year}, {month}, 1)"
    return f"({first} + ((8 - isodow({first})) % 7)::int + 1)::date"


CTE["fed_years"] = """
select distinct (year(registered_date) - year(registered_date) % 2)::int as y from raw"""


def federal(years: str) -> str:
    return f"""
select {tuesday('y', 11)} as election_date, y as election_year, y || ' Federal General Election' as election_name,
  case when y % 4 = 0 then 'Presidential' else 'Midterm' end as election_type, 'Federal' as election_level,
  case when y % 4 = 0 then 'President' else 'Congress' end as office_type, false as is_primary,
  null::varchar as state, 'Calculated Federal Schedule' as data_source from {years}
union all
select {tuesday('y', 3)}, y, y || ' Super Tuesday Presidential Primary', 'Primary', 'Federal', 'President', true,
  'Multiple', 'Calculated Federal Schedule' from {years} where y % 4 = 0"""


CTE["calendar_years"] = "select y::int as y from range(2022, 2031, 2) t(y)"
CTE["computed"] = federal("calendar_years")
STATE_CODES = ("AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC "
               "ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY").split()
CODES = ", ".join(f"'{c}'" for c in STATE_CODES)
CTE["classified"] = f"""
select election_date, election_year, election_name,
  case when l like '%primary%' then 'Primary' when l like '%special%' then 'Special'
    when election_year % 4 = 0 then 'Presidential' when election_year % 2 = 0 then 'Midterm' else 'Off-Year' end
    as election_type,
  case when regexp_matches(l, 'federal|presidential|senate|congress') then 'Federal'
    when regexp_matches(l, 'state|governor|legislature') then 'State'
    when regexp_matches(l, 'county|city|local|municipal') then 'Local' else 'General' end as election_level,
  case when l like '%president%' then 'President' when l like '%senate%' then 'Senate'
    when regexp_matches(l, 'house|congress') then 'House' when l like '%governor%' then 'Governor' else 'General' end
    as office_type,
  l like '%primary%' as is_primary,
  list_filter(string_split(upper(election_name), ' '), lambda w: w in ({CODES}))[1] as state,
  'Google Civic Information API' as data_source, seq
from (select name as election_name, lower(name) as l, seq, replace("electionDay", 'T00:00:00Z', '')::date as election_date,
  year(replace("electionDay", 'T00:00:00Z', '')::date)::int as election_year from civic)"""
CTE["upcoming"] = """
select * exclude (source, seq, place) from (select *, row_number() over (
    partition by election_date, election_type, election_level, state order by source, seq) as place
  from (select *, 0 as source from classified union all by name select *, 1 as source, election_year as seq from computed))
where place = 1"""
CTE["historic"] = f"""
select {tuesday('year', 11)} as election_date, year as election_year, year || ' Presidential Election' as election_name,
  'Presidential' as election_type, 'Federal' as election_level, 'President' as office_type, false as is_primary,
  null::varchar as state, 'MIT Election Lab' as data_source, total::bigint as total_votes_cast, candidate as winner_name,
  party_simplified as winner_party, candidatevotes::bigint as winner_votes
from (select *, sum(totalvotes) over (partition by year) as total,
  row_number() over (partition by year order by candidatevotes desc, seq) as place from results)
where place = 1"""
SHARED = """election_date, election_year, election_name, election_type, election_level, office_type, is_primary, state,
  data_source"""


def sql(body: str) -> str:
    """The body with the sub-queries it mentions, directly or not, in front."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in sorted(set(re.findall(r"\b(?:from|join)\s+([a-z_]+)", text))):
            if name in CTE and name not in needed:
                need(CTE[name])
                needed.append(name)

    need(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{n} as ({CTE[n].strip()})" for n in needed) + "\n" + body


# --- tables as they are published ----------------------------------------------------------------
CTE["records"] = f"select uuid()::varchar as record_uuid, {STAMPED} from ingested"
METADATA = """select 1::int as id, timestamp '2025-06-30 12:00:00' as last_processed_at, 2::int as files_processed,
  (select count(*) from ingested)::int as records_processed, count(distinct source_id)::int as voter_count,
  count(distinct state)::int as state_count, timestamp '2025-06-29 12:00:00' as created_at,
  timestamp '2025-06-30 12:00:00' as updated_at from raw"""
CTE["metadata"] = METADATA
RESULT_ROWS = """select year, null::varchar as state, state_po, null::int as state_fips, null::int as state_cen,
  null::int as state_ic, null::varchar as office, candidate, null::varchar as party_detailed, null::varchar as writein,
  candidatevotes, totalvotes, null::varchar as version, seq::varchar as notes, party_simplified from results"""
CTE["result_rows"] = f"select *, '2025-06-30 00:00:00+00:00' as insertion_date from ({RESULT_ROWS})"
CTE["historic_seed"] = "select uuid()::varchar as election_id, *, '2025-06-30 00:00:00+00:00' as last_updated from historic"
CTE["upcoming_seed"] = "select uuid()::varchar as election_id, *, '2025-06-30 00:00:00+00:00' as last_updated from upcoming"
TABLES = {
    "vote_records": "records", "processing_metadata": "metadata", "dim_voter": "dim", "stage_voter_metrics": "stage",
    "voter_snapshot": "snapshot", "partisan_trends": "trends", "targeting_opportunities": "targeting",
    "state_summary": "summary", "elections_historic_raw": "result_rows",
    "election_outcome_federal_historic": "historic_seed", "election_calendar_upcoming": "upcoming_seed",
}

# The declared columns of every table, in their order.
COLUMNS = {
    "vote_records": """record_uuid source_id first_name last_name age gender state party email registered_date
        last_voted_date source_file record_hash inserted_at updated_at""".split(),
    "processing_metadata": """id last_processed_at files_processed records_processed voter_count state_count created_at updated_at""".split(),
    "dim_voter": """source_id first_name last_name age gender state party email registered_date last_voted_date
        inserted_date last_modified_date""".split(),
    "stage_voter_metrics": """voter_id age_group gender state party registered_date days_since_registered years_since_registered
        last_voted_date elections_since_last_vote voter_engagement_segment last_vote_cycle_type
        last_processed_date""".split(),
    "voter_snapshot": """state age_group gender party voter_engagement_segment last_vote_cycle_type total_voters
        avg_years_registered median_years_registered avg_elections_missed current_voters missed_last_voters
        occasional_voters infrequent_voters dormant_voters never_voted targetable_voters
        high_opportunity_voters pct_current_voters pct_targetable_voters pct_high_opportunity_voters
        pct_missed_last_voters pct_occasional_voters pct_infrequent_voters pct_dormant_voters
        pct_never_voted snapshot_date""".split(),
    "partisan_trends": """election_year election_type election_date state age_group gender party eligible_voters
        estimated_voters participation_rate pct_of_eligible_by_demo pct_of_voters_by_demo
        prev_eligible_voters prev_participation_rate eligible_voter_change_pct participation_rate_change_pts""".split(),
    "targeting_opportunities": """state age_group gender party targeting_tier opportunity_score state_rank national_rank total_voters
        prime_target_voters broad_target_voters active_voters lapsed_1_election lapsed_2_3_elections
        lapsed_4_6_elections dormant_voters never_voted pct_prime_targets pct_broad_targets
        pct_active_voters pct_recently_lapsed pct_medium_lapsed pct_dormant pct_never_voted
        avg_elections_missed avg_registration_tenure analysis_date""".split(),
    "state_summary": """state total_registered_voters pct_democrat pct_republican pct_independent pct_18_29 pct_30_49
        pct_50_64 pct_65_plus pct_female pct_male pct_current_voters pct_recoverable_voters
        pct_disengaged_voters pct_never_voted avg_elections_missed avg_years_registered
        median_years_registered democrat_voters republican_voters independent_voters current_voters
        recoverable_voters disengaged_voters engagement_opportunity_score partisan_lean summary_date""".split(),
    "elections_historic_raw": """year state state_po state_fips state_cen state_ic office candidate party_detailed writein
        candidatevotes totalvotes version notes party_simplified insertion_date""".split(),
    "election_outcome_federal_historic": """election_id election_date election_year election_name election_type election_level office_type
        is_primary state total_votes_cast winner_name winner_party winner_votes data_source last_updated""".split(),
    "election_calendar_upcoming": """election_id election_date election_year election_name election_type election_level office_type
        is_primary state data_source last_updated""".split(),
}
# Tables whose definitions have their columns in another order.
for _label in ("voter_snapshot", "targeting_opportunities", "state_summary", "election_outcome_federal_historic"):
    CTE[f"ordered_{_label}"] = f"select {', '.join(COLUMNS[_label])} from {TABLES[_label]}"
    TABLES[_label] = f"ordered_{_label}"

# --- checks --------------------------------------------------------------------------------------
DAYS = ("date '1900-01-01'", "date '2025-06-30'")
MISSES, TENURE, SIZE = (0, 20), (0, 100), (1, 1_000_000)


def percentages(*names: str) -> dict[str, tuple]:
    return {f"pct_{name}": (0, 100) for name in names}


# The declared checks by kind, table and column.
GROUP_COLUMNS = ("state", "age_group", "gender", "party")
GROUP_VALUES = {
    "age_group": ("18-29", "30-49", "50-64", "65+"), "gender": ("M", "F"),
    "party": ("Democrat", "Republican", "Independent"),
}
SEGMENT_VALUES = ("Current Voter", "Missed Last Election", "Occasional Voter", "Infrequent Voter", "Dormant Voter", "Never Voted")
CYCLE_VALUES = ("Presidential Year", "Midterm Year", "Off-Year/Primary")
CALENDAR_VALUES = {
    "election_type": ("Presidential", "Midterm", "Primary", "Special", "Off-Year"),
    "office_type": ("President", "Senate", "House", "Congress", "Governor", "General"),
}
CALENDAR_NULLS = ("election_id", "election_date", "election_year", "election_name", "is_primary", "data_source", "last_updated")
NOT_NULL = {
    "vote_records": ("source_id",),
    "dim_voter": ("source_id", "first_name", "last_name", "age", "gender", "state", "party", "email", "registered_date",
                  "inserted_date", "last_modified_date"),
    "stage_voter_metrics": ("voter_id", *GROUP_COLUMNS, "registered_date", "days_since_registered",
                            "years_since_registered", "voter_engagement_segment", "last_processed_date"),
    "voter_snapshot": (*GROUP_COLUMNS, "voter_engagement_segment", "total_voters", "snapshot_date"),
    "partisan_trends": ("election_year", "election_type", "election_date", *GROUP_COLUMNS, "eligible_voters", "estimated_voters"),
    "targeting_opportunities": (*GROUP_COLUMNS, "targeting_tier", "state_rank", "national_rank", "total_voters", "analysis_date"),
    "state_summary": ("state", "total_registered_voters", "partisan_lean", "summary_date"),
    "elections_historic_raw": ("year", "state", "state_po", "office", "candidatevotes", "totalvotes"),
    "election_outcome_federal_historic": CALENDAR_NULLS,
    "election_calendar_upcoming": (*CALENDAR_NULLS, "election_type", "election_level", "office_type"),
}
ACCEPTED = {
    "dim_voter": {c: GROUP_VALUES[c] for c in ("gender", "party")},
    "stage_voter_metrics": {**GROUP_VALUES, "elections_since_last_vote": tuple(range(10)),
                            "voter_engagement_segment": SEGMENT_VALUES, "last_vote_cycle_type": CYCLE_VALUES},
    "voter_snapshot": {**GROUP_VALUES, "voter_engagement_segment": SEGMENT_VALUES, "last_vote_cycle_type": CYCLE_VALUES},
    "partisan_trends": {**GROUP_VALUES, "election_type": ("Presidential", "Midterm")},
    "targeting_opportunities": {**GROUP_VALUES, "targeting_tier": ("High Priority", "Medium Priority", "Low Priority", "Monitor Only")},
    "state_summary": {"partisan_lean": ("Highly Competitive", "Competitive", "Lean Democrat", "Lean Republican")},
    "elections_historic_raw": {"party_simplified": ("DEMOCRAT", "REPUBLICAN", "LIBERTARIAN", "GREEN", "OTHER")},
    "election_outcome_federal_historic": {**CALENDAR_VALUES, "election_level": ("Federal", "State", "Local"),
                                          "data_source": ("MIT Election Lab",)},
    "election_calendar_upcoming": {**CALENDAR_VALUES, "election_level": ("Federal", "State", "Local", "General"),
                                   "data_source": ("Google Civic Information API", "Calculated Federal Schedule")},
}
BETWEEN = {
    "dim_voter": {"age": (18, 120), "registered_date": DAYS, "last_voted_date": DAYS},
    "stage_voter_metrics": {"registered_date": DAYS, "days_since_registered": (0, 50000), "years_since_registered": TENURE,
                            "last_voted_date": DAYS, "elections_since_last_vote": MISSES},
    "voter_snapshot": {"total_voters": SIZE, "avg_years_registered": TENURE, "median_years_registered": TENURE,
                       "avg_elections_missed": MISSES, **percentages(*ENGAGED)},
    "partisan_trends": {"election_year": (2008, 2030), "participation_rate": (0, 100),
                        **percentages("of_eligible_by_demo", "of_voters_by_demo"),
                        "eligible_voter_change_pct": (-100, 1000), "participation_rate_change_pts": (-100, 100)},
    "targeting_opportunities": {
        "opportunity_score": (0, 100), "state_rank": (1, 1000), "national_rank": (1, 10000), "total_voters": SIZE,
        "avg_elections_missed": MISSES, "avg_registration_tenure": TENURE,
        **percentages("prime_targets", "broad_targets", "active_voters", "recently_lapsed", "medium_lapsed", "dormant", "never_voted")},
    "state_summary": {**{name: (0, 100) for name in STATE_SHARES}, "avg_elections_missed": MISSES,
                      "avg_years_registered": TENURE, "median_years_registered": TENURE, "engagement_opportunity_score": (0, 100)},
}
UNIQUE = {"dim_voter": "source_id", "stage_voter_metrics": "voter_id", "state_summary": "state",
          "election_outcome_federal_historic": "election_id", "election_calendar_upcoming": "election_id"}


def row_checks(label: str, checks: list[tuple[str, str, str]]) -> str:
    """(check, column, failing predicate) rows of one table."""
    counts = ", ".join(f"count(*) filter (where {p}) as f{i}" for i, (_, _, p) in enumerate(checks))
    counted = f"(select count(*) as total, {counts} from {TABLES[label]})"
    return "\nunion all ".join(
        f"select '{n}' as check_name, '{c}' as column_name, total as total_rows, f{i}::bigint as failing_rows, "
        f"f{i} = 0 as passed, '{label}' as table_name from {counted}"
        for i, (n, c, _) in enumerate(checks)
    )


def key_check(label: str, name: str, columns: str, where: str = "true", table: str = "") -> str:
    return f"""select '{name}' as check_name, '{columns.replace(', ', ',')}' as column_name,
  coalesce(sum(n), 0)::bigint as total_rows,
  count(*) filter (where n > 1 and {where})::bigint as failing_rows,
  count(*) filter (where n > 1 and {where}) = 0 as passed, '{label}' as table_name
from (select {columns}, count(*) as n from {table or TABLES[label]} group by all)"""


def not_null_checks(label: str, columns: tuple[str, ...]) -> str:
    return row_checks(label, [("not_null", c, f"{c} is null") for c in columns])


def accepted_checks(label: str) -> str:
    return row_checks(label, [("accepted_values", c, f"{c} not in ({', '.join(map(repr, values))})")
                              for c, values in ACCEPTED[label].items()])


def between_checks(label: str) -> str:
    return row_checks(label, [("between", c, f"{c} < {low} or {c} > {high}") for c, (low, high) in BETWEEN[label].items()])


def unique_check(label: str, column: str) -> str:
    return key_check(label, "unique", column, f"{column} is not null")


def columns_check(label: str) -> str:
    """The declared columns against those that a row of the table has, in order."""
    declared = COLUMNS[label]
    found = f"(select json_keys(to_json(t)) from (select * from {TABLES[label]} limit 1) t)"
    return f"""select 'columns_match' as check_name, '*' as column_name, count(*) as total_rows,
  ({found} <> {declared})::bigint as failing_rows, {found} = {declared} as passed, '{label}' as table_name from {TABLES[label]}"""


def contract_checks(label: str) -> str:
    contract = schemas.CONTRACTS[label]
    parts = [columns_check(label), *([not_null_checks(label, contract.required)] if contract.required else [])]
    return " union all ".join(parts + [unique_check(label, c) for c in contract.unique])


def wide(index: str, measure: str, column: str, values: tuple[str, ...], table: str) -> str:
    cells = ", ".join(
        f"{'-' if v == 'M' else ''}coalesce(sum({measure}) filter (where {column} = '{v}'), 0)::bigint as \"{v}\""
        for v in values)
    return f"select {index}, {cells} from {table} group by all"


HUNDREDTHS = "sum(round({c} * 100, 0)::bigint) / (count({c}) * 100.0)"
PIVOT_PARTY = ("Democrat", "Republican", "Independent")

ORACLES: dict[str, str] = {
    "dim_voter": "select * from dim",
    "stage_voter_metrics": "select * from stage",
    "voter_snapshot": "select * from snapshot",
    "voter_snapshot_any_stage": "select * from snapshot",
    "partisan_trends": "select * from trends",
    "targeting_opportunities": "select * from targeting where total_voters >= 1",
    "state_summary": "select * from summary",
    "elections_since_last_vote": """select source_id, last_voted_date,
  case when last_voted_date is not null then (select count(*) from cycles where election_date > last_voted_date) end::int
    as elections_since_last_vote,
  case when last_voted_date is not null then (select count(*) from cycles where election_date > last_voted_date) end::int
    as elections_in_calendar from dim""",
    "voter_eligibility": "select * from eligibility",
    "demo_totals": "select * from demo",
    "party_totals": "select * from by_party",
    "election_cycles": """select election_year, election_type, election_date,
  sum(was_registered)::bigint as registered_voters, sum(likely_voted)::bigint as likely_voters
from eligibility group by all""",
    "record_hash": "select source_id, record_hash from hashed",
    "clean_voters": CLEANED,
    "scan_voter_csv": CLEANED,
    "dedup_antijoin": """select source_id, last_voted_date, record_hash from hashed
where record_hash not in (select record_hash from hashed where registered_date < date '2005-01-01')""",
    "dedup_across_files": """select source_id, last_voted_date, record_hash,
  'voters_' || file_number || '.csv' as source_file from ingested
where record_hash not in (select record_hash from hashed where registered_date < date '2005-01-01')""",
    "ingest_voters": f"select {STAMPED} from ingested",
    "ingest_truncate": f"select {STAMPED} from filed",
    "ingest_metrics": """select count(distinct source_id)::bigint as voter_count,
  count(distinct state)::bigint as state_count from raw""",
    "run_metadata": """select *, timestamp '2025-06-29 12:00:00' as watermark, timestamp '2025-01-01 00:00:00' as fallback
from metadata""",
    "dim_upsert": "select * from second_dim",
    "dim_upsert_same_day": """select * replace (date '2025-06-30' as inserted_date, date '2025-06-30' as last_modified_date)
from first_dim""",
    "stage_upsert": """select * from first_stage where voter_id not in (select voter_id from new_stage)
union all by name select * from new_stage""",
    "scan_new_files": """select source_id as id, first_name, last_name, age::varchar as age, gender, state, party, email,
  strftime(registered_date, '%Y-%m-%d') as registered_date, strftime(last_voted_date, '%Y-%m-%d') as last_voted_date
from later""",
    "file_quality_gate": """select variant, can_process, error, header_columns::int as header_columns,
  extra_columns::int as extra_columns, missing_columns,
  if(variant = 'headed', 0, total)::bigint as total_rows, if(variant = 'blank', total, 0)::bigint as error_rows
from (select count(*) as total from raw), (values
  ('good', true, null, 10, 0, ''), ('wide', true, null, 80, 70, ''),
  ('short', false, 'too few header columns', 2, 0, 'last_name, age, gender, state, party, email, registered_date, last_voted_date'),
  ('blank', false, 'too many empty rows', 10, 0, ''), ('headed', false, 'no data rows', 10, 0, ''),
  ('renamed', false, 'missing columns email', 10, 0, 'email')
) as t(variant, can_process, error, header_columns, extra_columns, missing_columns)""",
    "schema_check": " union all ".join(
        f"select '{c}' as column_name, {e} as expected, {p} as present, "
        f"{'count(' + src + ')' if src else '(0 * count(*))'}::bigint as filled_rows, {v} as valid, {n}::varchar as note from raw"
        for c, e, p, src, v, n in [
            ("id", "true", "true", "source_id", "true", "null"),
            ("first_name", "true", "true", "first_name", "true", "null"),
            ("last_name", "true", "true", "last_name", "true", "null"),
            ("age", "true", "true", "age", "true", "null"),
            ("gender", "true", "true", "", "true", "'empty'"),
            ("state", "true", "true", "state", "true", "null"),
            ("party", "true", "true", "party", "true", "null"),
            ("email", "true", "false", "", "false", "'missing'"),
            ("registered_date", "true", "true", "registered_date", "true", "null"),
            ("last_voted_date", "true", "true", "last_voted_date", "true", "null"),
            ("ward", "false", "true", "state", "true", "'ignored'"),
        ]),
    "scan_results_tsv": RESULT_ROWS,
    "scan_civic_json": 'select id, name, "electionDay" from civic',
    "seed_load": f"""select 'election_outcome_federal_historic' as seed, {SHARED}, total_votes_cast, winner_name,
  winner_party, winner_votes::int as winner_votes, timestamp '2025-06-30 00:00:00' as last_updated from historic
union all select 'election_calendar_upcoming', {SHARED}, null, null, null, null, timestamp '2025-06-30 00:00:00' from upcoming""",
    "catalog_tables": """select 'fact' as table_schema, 'election_outcome_federal_historic' as table_name,
  count(*) as row_count from historic
union all select 'dim', 'election_calendar_upcoming', count(*) from upcoming""",
    "csv_sink": """select strftime(election_date, '%Y-%m-%d') as election_date, election_year::varchar as election_year,
  election_name, election_type, election_level, office_type, is_primary::varchar as is_primary, state, data_source
from upcoming""",
    "ingest_stream": f"""select * exclude (wave), timestamp '2025-06-30 00:00:00' as inserted_at,
  timestamp '2025-06-30 00:00:00' as updated_at
from (select *, 1 as wave from hashed where last_voted_date is null or last_voted_date < date '2012-01-01'
  union all select *, 2 as wave from hashed where last_voted_date >= date '2012-01-01' and record_hash not in (
    select record_hash from hashed where last_voted_date is null or last_voted_date < date '2012-01-01'))""",
    "election_day": f"""select source_id, year(registered_date)::int as registration_year,
  {tuesday('year(registered_date)', 11)} as november, {tuesday('year(registered_date)', 3)} as march from raw""",
    "federal_calendar": federal("fed_years"),
    "classify_elections": "select * from classified",
    "historic_outcomes": "select * from historic",
    "upcoming_calendar": "select * from upcoming",
    "finalize_calendar": """select strftime(election_date, '%Y-%m-%d') as election_date,
  election_year::bigint as election_year, * exclude (election_date, election_year),
  '2025-06-30 00:00:00+00:00' as last_updated from historic""",
    "unified_calendar": f"select {SHARED} from historic union all select {SHARED} from upcoming",
    "calendar_by_source": """select data_source, count(*) as elections, min(election_date) as first_date,
  max(election_date) as last_date from upcoming group by data_source""",
    "dq_not_null": " union all ".join(not_null_checks(label, columns) for label, columns in NOT_NULL.items()),
    "dq_unique": " union all ".join(unique_check(label, column) for label, column in UNIQUE.items()),
    "dq_accepted_values": " union all ".join(map(accepted_checks, ACCEPTED)),
    "dq_between": " union all ".join(map(between_checks, BETWEEN)),
    "dq_regex": row_checks("dim_voter", [
        ("matches_regex", "email", r"not regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')")])
    + " union all " + row_checks("stage_voter_metrics", [
        ("matches_regex", "voter_id", "not regexp_matches(voter_id, '^[A-Za-z0-9_-]+$')"),
        ("matches_regex", "state", "not regexp_matches(state, '^[A-Z]{2}$')")]),
    "dq_length": row_checks("dim_voter", [
        ("length_between", "first_name", "length(first_name) not between 1 and 100"),
        ("length_between", "last_name", "length(last_name) not between 1 and 100"),
        ("length_equals", "state", "length(state) <> 2")]) + " union all " + " union all ".join(
        row_checks(label, [("length_equals", "state", "length(state) <> 2")])
        for label in ("stage_voter_metrics", "voter_snapshot", "partisan_trends", "targeting_opportunities")),
    "dq_pair_order": row_checks("dim_voter", [
        ("at_least", "last_voted_date>=registered_date", "last_voted_date < registered_date")]),
    "dq_row_count": """select 'row_count_between' as check_name, '*' as column_name, count(*) as total_rows,
  (count(*) not between 1 and 60)::bigint as failing_rows, count(*) between 1 and 60 as passed,
  'state_summary' as table_name from summary""",
    "dq_columns": columns_check("stage_voter_metrics"),
    "dq_unique_combo": key_check("election_calendar_upcoming", "unique_combination",
                                 "election_date, election_type, election_level, state") + " union all "
    + key_check("civic_listings", "unique_combination", "election_date, election_type, election_level, state",
                table="classified"),
    "contract_check": " union all ".join(map(contract_checks, TABLES)),
    "dash_kpis": f"""select sum(total_registered_voters)::bigint as total_registered_voters,
  {HUNDREDTHS.format(c='pct_current_voters')} as avg_engagement_pct from summary""",
    "dash_engagement_trend": f"""select election_year, party, {HUNDREDTHS.format(c='participation_rate')}
    as avg_participation_rate from trends where participation_rate > 0 group by all""",
    "dash_top_targets": """select place::int as place, state, age_group, party,
  case when best > 100 then round_even(opportunity_score / best * 100 * 10, 0) / 10
    else round_even(opportunity_score * 10, 0) / 10 / 100 end::double as opportunity_score_display
from (select *, row_number() over (order by opportunity_score desc, national_rank) as place,
    max(opportunity_score) over () as best
  from (select * from targeting where targeting_tier in ('High Priority', 'Medium Priority')
    order by opportunity_score desc, national_rank limit 20)) where place <= 10""",
    "dash_state_grid": """select state, ((place - 1) // 3)::int as grid_row, ((place - 1) % 3)::int as grid_col,
  round_even(engagement_opportunity_score * 10, 0)::double / 10 as engagement_opportunity_score,
  round_even(pct_recoverable_voters * 10, 0)::double / 10 as pct_recoverable_voters,
  printf('%s<br>%.1f%% rec<br>%.1f eng', state, round_even(pct_recoverable_voters * 10, 0)::double / 10,
    round_even(engagement_opportunity_score * 10, 0)::double / 10) as label
from (select *, row_number() over (order by engagement_opportunity_score desc, total_registered_voters desc, state) as place
  from summary) where place <= 15""",
    "dash_gender_engagement": "select *, case voter_engagement_segment when 'Current Voter' then 0 "
    "when 'Missed Last Election' then 1 when 'Occasional Voter' then 2 when 'Infrequent Voter' then 3 "
    "when 'Dormant Voter' then 4 else 5 end::int as segment_order from ("
    + wide("voter_engagement_segment, party", "total_voters", "gender", ("M", "F"), "snapshot") + ")",
    "dash_gender_party": """select gender, party, total_voters,
  round(100.0 * total_voters / sum(total_voters) over (partition by gender), 2)::double as pct_of_gender
from (select gender, party, sum(total_voters)::bigint as total_voters from snapshot group by all)""",
    "dash_reg_by_year": """select year(registered_date)::int as registration_year, count(*) as registered_voters
from stage group by all""",
    "dash_gender_year": wide("year(registered_date)::int as registration_year, party", "1", "gender", ("M", "F"), "stage"),
    "dash_age_party": wide("age_group", "1", "party", PIVOT_PARTY, "stage"),
    "example_snapshot": "select state, party, pct_current_voters, pct_targetable_voters from snapshot",
    "example_trends": """select election_year, election_type, state, participation_rate from trends
where party = 'Democrat' and state = 'PA'""",
    "example_targets": """select state, age_group, gender, party, opportunity_score, prime_target_voters from targeting
where targeting_tier = 'High Priority' order by opportunity_score desc, national_rank limit 20""",
    "example_states": """select state, partisan_lean, engagement_opportunity_score, total_registered_voters from summary
where partisan_lean in ('Highly Competitive', 'Competitive')""",
}
ORACLES["dash_states"] = ORACLES["state_summary"]
ORACLES["dash_segments"] = ORACLES["voter_snapshot"]
ORACLES["dash_stage"] = ORACLES["stage_voter_metrics"]


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in ORACLES.items()}
