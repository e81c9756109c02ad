"""DuckDB oracle: one SQL text per registered query.

Written independently of the Spark operators: plain CTE chains over the
driver's tables (``customer``, ``supplier``, ``orders``). E1 renumbers the
rows with a global ``row_number()`` after every pass instead of carrying an
order key, match/attach use GROUP BY + ``max_by``/``min_by``, merges use
``row_number()`` windows. Only the fixed values and the conf rows are shared.
"""

from __future__ import annotations

from .functions import fixed
from .sources.conf import KEYWORD_ROWS, PREFECTURE_ROWS, REPLACE_ROWS, replace_order

RUN_TS = "TIMESTAMP '1997-01-15 13:00:00'"
FEEDS = ("crm", "name_card", "purchase", "sales", "invoice")
PERSON_FEEDS = ("crm", "name_card", "purchase", "sales")


def lit(s) -> str:
    if s is None:
        return "NULL"
    return "'" + str(s).replace("'", "''") + "'"


def _kw(cat):
    return [w for c, w in KEYWORD_ROWS if c == cat]


def _rp(cat):
    return replace_order([(b, a) for c, b, a in REPLACE_ROWS if c == cat])


# ---- text rules in DuckDB SQL ---------------------------------------------------
FW = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
HW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
HIRA = "".join(chr(c) for c in range(0x3041, 0x3097))
KATA = "".join(chr(c + 0x60) for c in range(0x3041, 0x3097))


def r1(x):
    return f"regexp_replace(coalesce({x}, ''), '[ 　]', '', 'g')"


def r2(x):
    return fr"regexp_replace(coalesce({x}, ''), '\P{{Nd}}', '', 'g')"


def r3(x, cat):
    out = f"coalesce({x}, '')"
    for b, a in _rp(cat):
        out = f"replace({out}, {lit(b)}, {lit(a)})"
    return out


def r5(x):
    return f"translate({x}, {lit(FW)}, {lit(HW)})"


def r6(x):
    out = f"coalesce({x}, '')"
    singles_from, singles_to = "", ""
    for k, v in fixed.HALF_TO_FULL_KANA.items():
        if len(k) == 2:
            out = f"replace({out}, {lit(k)}, {lit(v)})"
        else:
            singles_from += k
            singles_to += v
    out = f"translate({out}, {lit(singles_from)}, {lit(singles_to)})"
    return f"translate({out}, 'ヵヶ', 'カケ')"


def r7(x):
    return f"translate({x}, {lit(HIRA)}, {lit(KATA)})"


def name_sql(x):
    return r6(r1(x))


def kana_sql(x):
    return r7(r6(r1(x)))


def company_sql(x):
    return r3(r3(r6(r5(r1(x))), "1"), "2")


def address_sql(x):
    s = r3(r6(r5(r1(x))), "1")
    s = fr"regexp_replace({s}, '(\p{{Nd}}+)(丁目|番地|号室|号)', '\1-', 'g')"
    # RE2 has no look-ahead: a run of hyphens before a non-digit / the end keeps
    # only the character after it
    return fr"regexp_replace({s}, '-+(\P{{Nd}}|$)', '\1', 'g')"


def mail_sql(x):
    return f"lower({r1(x)})"


def dept_sql(x):
    return r3(r6(r5(r1(x))), "1")


def starts_any(x, prefixes):
    if not prefixes:
        return "false"
    return "(" + " OR ".join(f"starts_with({x}, {lit(p)})" for p in prefixes) + ")"


PHONE_KW = ["".join(ch for ch in k if ch.isdigit()) for k in _kw("1")]
MAIL_KW = [k.replace(" ", "").replace("　", "").lower() for k in _kw("2")]
PRES_KW = _kw("3")
PREF_PAT = "[一-龥]{2,3}(都|道|府|県)"


def pref_extract(x):
    return f"coalesce(regexp_extract({x}, {lit(PREF_PAT)}, 0), '')"


# ---- CTE chain -------------------------------------------------------------------
class Chain:
    def __init__(self):
        self.ctes: list[tuple[str, str]] = []
        self.n = 0
        self.add("pref", "SELECT * FROM (VALUES " + ", ".join(
            f"({lit(c)}, {lit(n)})" for c, n in PREFECTURE_ROWS) + ") t(prefecture_code, prefecture_name)")

    def add(self, name, body):
        self.ctes.append((name, body))
        return name

    def new(self, base, body):
        self.n += 1
        return self.add(f"{base}_{self.n}", body)

    def sql(self, final):
        return "WITH " + ",\n".join(f"{n} AS (\n{b}\n)" for n, b in self.ctes) + "\n" + final


# ---- feeds (FIXTURES.md section 2) -----------------------------------------------
PREF = "CASE e%4 WHEN 0 THEN '東京都' WHEN 1 THEN '大阪府' WHEN 2 THEN '北海道' ELSE '神奈川県' END"
STREET = ("'中央区'||CAST(e%9+1 AS STRING)||'丁目'||CAST(e%20+1 AS STRING)||'番地'"
          "||CAST(e%30+1 AS STRING)||'号'")
CNAME = ("CASE k%3 WHEN 0 THEN '株式会社取引先'||es "
         "WHEN 1 THEN '（株）取引先'||translate(es,'0123456789','０１２３４５６７８９') "
         "ELSE '㈱ 取引先'||es END")
PNO = "CAST(CASE WHEN k%10=1 THEN k-1 ELSE k END AS STRING)"
DOM = "CAST(e - e%12 AS STRING)"
EMAIL = ("CASE WHEN k%37=0 THEN 'bad.example' WHEN k%4=0 THEN 'INFO@e'||" + DOM + "||'.example' "
         "WHEN k%41=0 THEN NULL ELSE 'taro'||" + PNO + "||'@e'||es||'.example' END")
PHONE = ("CASE WHEN k%31=0 THEN '0312' WHEN k%5=0 THEN '090-'||lpad(CAST(k%10000 AS STRING),4,'0')||'-0000' "
         "WHEN k%43=0 THEN NULL ELSE '03-'||lpad(CAST(e%10000 AS STRING),4,'0')||'-1111' END")
POST = "'〒'||lpad(CAST(e%1000 AS STRING),3,'0')||'-'||lpad(CAST(e%10000 AS STRING),4,'0')"
INVNO = "CASE WHEN k%23=0 THEN 'T12' ELSE 'T'||lpad(es,13,'0') END"
JOB = "CASE k%6 WHEN 0 THEN '代表取締役' WHEN 1 THEN '-' WHEN 2 THEN NULL ELSE '課長' END"

BASES = {
    "crm": ("customer", "c_custkey", "c_custkey - c_custkey%3"),
    "name_card": ("customer", "c_custkey", "c_custkey - c_custkey%3"),
    "purchase": ("supplier", "s_suppkey", "(s_suppkey - s_suppkey%2)*3"),
    "invoice": ("supplier", "s_suppkey", "(s_suppkey - s_suppkey%2)*3"),
    "sales": ("orders", "o_orderkey", "o_custkey - o_custkey%3"),
}

FEED_SELECT = {
    "crm": f"""{CNAME} AS company_name, '営業部' AS department, '山田 太郎'||{PNO} AS name,
 'やまだ ﾀﾛｳ' AS name_kana, {JOB} AS job_post, {EMAIL} AS email, {PHONE} AS phone_number,
 'https://e'||es||'.example' AS url, CAST(NULL AS STRING) AS postal_code,
 CASE WHEN k%29=0 THEN '東京' ELSE {PREF} END AS prefecture, {STREET} AS address, 'ＩＴ' AS industry,
 CASE WHEN k%3<>0 THEN CAST(e%500 AS BIGINT) END AS employees_volume, CAST(e%1000*1000 AS BIGINT) AS annual_revenue,
 k%2=0 AS contact_permission""",
    "name_card": f"""'山田' AS family_name, CASE WHEN k%11=0 THEN NULL ELSE '太郎'||{PNO} END AS first_name,
 'やまだ' AS family_name_kana, 'ﾀﾛｳ' AS first_name_kana, '営業１部' AS department_name,
 {JOB} AS position_name, lpad(es,7,'0') AS postal_code, {CNAME} AS company_name,
 {PREF}||{STREET} AS address,
 CASE WHEN k%2=0 THEN 'ＡＢＣビル'||CAST(k%9 AS STRING)||'Ｆ' END AS building, {PHONE} AS phone_number,
 '03-'||lpad(CAST(e%10000 AS STRING),4,'0')||'-1111' AS company_phone_number, {EMAIL} AS email,
 'info@e'||{DOM}||'.example' AS company_email""",
    "purchase": f"""{CNAME} AS company_name, '佐藤　次郎'||{PNO} AS opponent_staff_name,
 {PHONE} AS phone_number, {EMAIL} AS email_address, {POST}||{PREF}||{STREET} AS address,
 {INVNO} AS invoice_company_number""",
    "sales": f"""{CNAME} AS customer_company_name, '鈴木 花子'||CASE WHEN k%7=0 THEN es ELSE CAST(k AS STRING) END AS customer_person_name,
 CASE WHEN k%7=0 THEN '090-'||lpad(CAST(e%10000 AS STRING),4,'0')||'-0000' ELSE {PHONE} END AS phone_number1,
 CASE WHEN k%3=0 THEN '080-'||lpad(CAST(k%10000 AS STRING),4,'0')||'-2222' END AS phone_number2,
 {EMAIL} AS email_address, {POST}||' '||{PREF}||{STREET} AS address""",
    "invoice": f"""{CNAME} AS invoice_issuer, {PHONE} AS tel_number,
 CASE WHEN k%19=0 THEN '1' ELSE '03-'||lpad(CAST(e%10000 AS STRING),4,'0')||'-9999' END AS fax_number,
 'info@e'||{DOM}||'.example' AS email, {POST}||{PREF}||{STREET} AS address,
 {INVNO} AS invoice_company_number""",
}

WORK_COLS = {
    "crm": ["company_name", "department", "name", "name_kana", "job_post", "email", "phone_number", "url",
            "postal_code", "prefecture", "address", "industry", "employees_volume", "annual_revenue",
            "contact_permission"],
    "name_card": ["family_name", "first_name", "family_name_kana", "first_name_kana", "department_name",
                  "position_name", "postal_code", "company_name", "address", "building", "phone_number",
                  "company_phone_number", "email", "company_email"],
    "purchase": ["company_name", "opponent_staff_name", "phone_number", "email_address", "address",
                 "invoice_company_number"],
    "sales": ["customer_company_name", "customer_person_name", "phone_number1", "phone_number2",
              "email_address", "address"],
    "invoice": ["invoice_issuer", "tel_number", "fax_number", "email", "address", "invoice_company_number"],
}


def base_sql(feed, extra=""):
    table, k, e = BASES[feed]
    return f"SELECT k, e, CAST(e AS STRING) AS es{extra} FROM (SELECT {k} AS k, {e} AS e" + \
        (", o_orderdate AS day" if extra else "") + f" FROM {table}) q"


def work(ch: Chain, feed: str) -> str:
    name = f"work_{feed}"
    if any(n == name for n, _ in ch.ctes):
        return name
    return ch.add(name, f"SELECT k AS seq, {FEED_SELECT[feed]}\nFROM ({base_sql(feed)}) b")


# ---- validation ------------------------------------------------------------------
RULES = {
    "crm": [("mail", "email"), ("phone", "phone_number"), ("pref", "prefecture"),
            ("name_only", "email", ["phone_number"])],
    "name_card": [("mail", "email"), ("mail", "company_email"), ("phone", "phone_number"),
                  ("phone", "company_phone_number"), ("pref", "address"),
                  ("name_only", "email", ["phone_number"])],
    "purchase": [("mail", "email_address"), ("phone", "phone_number"), ("pref", "address"),
                 ("name_only", "email_address", ["phone_number"]), ("inv", "invoice_company_number")],
    "sales": [("mail", "email_address"), ("phone", "phone_number1"), ("phone", "phone_number2"),
              ("pref", "address"), ("name_only", "email_address", ["phone_number1", "phone_number2"])],
    "invoice": [("mail", "email"), ("phone", "tel_number"), ("fax", "fax_number"), ("pref", "address"),
                ("inv", "invoice_company_number")],
}
REASON = {"mail": fixed.INVALID_MAIL, "phone": fixed.INVALID_PHONE, "fax": fixed.INVALID_FAX,
          "pref": fixed.INVALID_PREFECTURE, "name_only": fixed.NAME_ONLY, "inv": fixed.INVALID_INVOICE_NO}


def rule_sql(rule) -> str:
    kind, c = rule[0], rule[1]
    if kind == "mail":
        p = f"{c} IS NOT NULL AND NOT contains({c}, '@')"
    elif kind in ("phone", "fax"):
        n = f"length({r2(c)})"
        p = f"{n} > 0 AND ({n} < 10 OR {n} > 11)"
    elif kind == "pref":
        p = f"{pref_extract(c)} NOT IN (SELECT prefecture_name FROM pref)"
    elif kind == "name_only":
        company = f"({starts_any(c, MAIL_KW)} AND {c} <> '')"
        personal = " OR ".join(f"coalesce({starts_any(ph, PHONE_KW)} AND {ph} <> '', false)" for ph in rule[2])
        p = f"coalesce({company}, false) AND NOT ({personal})"
    elif kind == "inv":
        p = f"{c} IS NOT NULL AND NOT regexp_matches({c}, '^T[0-9]{{13}}$')"
    else:
        raise ValueError(kind)
    return f"coalesce(({p}), false)"


def clean(ch: Chain, feed: str) -> str:
    name = f"clean_{feed}"
    if any(n == name for n, _ in ch.ctes):
        return name
    w = work(ch, feed)
    bad = " OR ".join(rule_sql(r) for r in RULES[feed])
    return ch.add(name, f"SELECT * FROM {w} WHERE NOT ({bad})")


def failing(ch: Chain, feed: str) -> str:
    """One row per (work row, failing rule)."""
    w = work(ch, feed)
    cols = ", ".join(WORK_COLS[feed])
    parts = [f"SELECT {cols}, seq, {i} AS rule_no, {lit(REASON[r[0]])} AS error_reason FROM {w} WHERE {rule_sql(r)}"
             for i, r in enumerate(RULES[feed])]
    return ch.new(f"hits_{feed}", "\nUNION ALL\n".join(parts))


def errors(ch: Chain, feed: str, offset: str = "0") -> str:
    cols = ", ".join(WORK_COLS[feed])
    hits = failing(ch, feed)
    return ch.new(f"err_{feed}", f"""SELECT {cols}, error_reason,
 CAST(row_number() OVER (ORDER BY rule_no, seq) + ({offset}) AS BIGINT) AS error_seq,
 {RUN_TS} AS insert_datetime FROM {hits}""")


# ---- standardising ---------------------------------------------------------------
def _phone_split(d):
    return (f"CASE WHEN {starts_any(d, PHONE_KW)} THEN {d} ELSE '' END",
            f"CASE WHEN {starts_any(d, PHONE_KW)} THEN '' ELSE {d} END")


def _mail_split(m):
    return (f"CASE WHEN {starts_any(m, MAIL_KW)} THEN {m} ELSE '' END",
            f"CASE WHEN {starts_any(m, MAIL_KW)} THEN '' ELSE {m} END")


def _job_chain(j):
    """R15 as sequential whole-value replaces on an already cleaned title."""
    steps = [f"CASE WHEN {j} = '' THEN '-' ELSE {j} END AS _j0"]
    prev = "_j0"
    for i, (b, a) in enumerate(_rp("3"), start=1):
        steps.append(f"CASE WHEN {prev} = {lit(b)} THEN {lit(a)} ELSE {prev} END AS _j{i}")
        prev = f"_j{i}"
    return steps, prev


def _postal_text(x):
    return f"ltrim({r3(r1(x), '1')}, '〒')"


def _postal(t):
    return fr"regexp_replace(regexp_extract({t}, '^(\p{{Nd}}{{3}}-?\p{{Nd}}{{4}})', 1), '\P{{Nd}}', '', 'g')"


def _after_postal(t):
    return fr"regexp_replace({t}, '^\p{{Nd}}{{3}}-?\p{{Nd}}{{4}}', '')"


NORM_COLS = {
    "crm": ["normalized_personal_phone_number", "normalized_company_phone_number", "normalized_personal_name",
            "normalized_personal_name_kana", "normalized_company_name", "normalized_full_address",
            "normalized_company_email", "normalized_personal_email", "normalized_department",
            "normalized_job_post"],
    "name_card": ["normalized_personal_phone_number", "normalized_company_phone_number",
                  "normalized_personal_name", "normalized_personal_name_kana", "normalized_company_name",
                  "normalized_full_address", "normalized_personal_email", "normalized_company_email",
                  "normalized_department", "normalized_postal_code", "normalized_job_post"],
    "purchase": ["normalized_company_name", "normalized_personal_name", "normalized_personal_phone_number",
                 "normalized_company_phone_number", "normalized_company_email", "normalized_personal_email",
                 "normalized_full_address", "normalized_postal_code"],
    "sales": ["normalized_company_name", "normalized_personal_name", "normalized_personal_phone_number",
              "normalized_company_phone_number", "normalized_company_email", "normalized_personal_email",
              "normalized_full_address", "normalized_postal_code"],
    "invoice": ["normalized_company_name", "normalized_company_phone_number", "normalized_company_fax_number",
                "normalized_company_email", "normalized_full_address", "normalized_postal_code"],
}
RAW_KEEP = {"crm": ["postal_code", "prefecture", "employees_volume", "annual_revenue", "url", "industry",
                    "contact_permission"],
            "purchase": ["invoice_company_number"], "invoice": ["invoice_company_number"]}


def standardized(ch: Chain, feed: str) -> str:
    """Clean rows with normalized_* columns (plus raw columns the views need)."""
    name = f"std_{feed}"
    if any(n == name for n, _ in ch.ctes):
        return name
    c = clean(ch, feed)
    keep = RAW_KEEP.get(feed, [])
    if feed == "crm":
        stage = ch.new("s1_crm", f"""SELECT seq, {', '.join(keep)},
 {r2('phone_number')} AS _phone, {mail_sql('email')} AS _mail,
 {name_sql('name')} AS normalized_personal_name, {kana_sql('name_kana')} AS normalized_personal_name_kana,
 {company_sql('company_name')} AS normalized_company_name,
 {address_sql('prefecture || address')} AS normalized_full_address,
 {dept_sql('department')} AS normalized_department, {dept_sql('job_post')} AS _job FROM {c}""")
        steps, last = _job_chain("_job")
        pp, cp = _phone_split("_phone")
        cm, pm = _mail_split("_mail")
        return ch.add(name, f"""SELECT seq, {pp} AS normalized_personal_phone_number,
 {cp} AS normalized_company_phone_number, normalized_personal_name, normalized_personal_name_kana,
 normalized_company_name, normalized_full_address, {cm} AS normalized_company_email,
 {pm} AS normalized_personal_email, normalized_department, {', '.join(steps)},
 {last} AS normalized_job_post, {', '.join(keep)} FROM {stage}""")
    if feed == "name_card":
        stage = ch.new("s1_nc", f"""SELECT seq, {r2('phone_number')} AS normalized_personal_phone_number,
 {r2('company_phone_number')} AS normalized_company_phone_number,
 {name_sql("coalesce(family_name,'') || coalesce(first_name,'')")} AS normalized_personal_name,
 {kana_sql("coalesce(family_name_kana,'') || coalesce(first_name_kana,'')")} AS normalized_personal_name_kana,
 {company_sql('company_name')} AS normalized_company_name,
 {address_sql("coalesce(address,'') || coalesce(building,'')")} AS normalized_full_address,
 {mail_sql('email')} AS normalized_personal_email, {mail_sql('company_email')} AS normalized_company_email,
 {dept_sql('department_name')} AS normalized_department, {dept_sql('position_name')} AS _job,
 {r2('postal_code')} AS normalized_postal_code FROM {c}""")
        steps, last = _job_chain("_job")
        cols = [x for x in NORM_COLS[feed] if x != "normalized_job_post"]
        return ch.add(name, f"SELECT seq, {', '.join(cols)}, {', '.join(steps)}, {last} AS normalized_job_post FROM {stage}")
    # purchase / sales / invoice carry "postal code + address" in one column
    extra = ", ".join(keep)
    extra = (extra + ", ") if extra else ""
    if feed == "purchase":
        s1 = f"""SELECT seq, {extra}{company_sql('company_name')} AS normalized_company_name,
 {name_sql('opponent_staff_name')} AS normalized_personal_name, {r2('phone_number')} AS _phone,
 {mail_sql('email_address')} AS _mail, {_postal_text('address')} AS _pt FROM {c}"""
    elif feed == "sales":
        s1 = f"""SELECT seq, {company_sql('customer_company_name')} AS normalized_company_name,
 {name_sql('customer_person_name')} AS normalized_personal_name, {r2('phone_number1')} AS _p1,
 {r2('phone_number2')} AS _p2, {mail_sql('email_address')} AS _mail, {_postal_text('address')} AS _pt FROM {c}"""
    else:
        s1 = f"""SELECT seq, {extra}{company_sql('invoice_issuer')} AS normalized_company_name,
 {r2('tel_number')} AS normalized_company_phone_number, {r2('fax_number')} AS normalized_company_fax_number,
 {mail_sql('email')} AS normalized_company_email, {_postal_text('address')} AS _pt FROM {c}"""
    stage = ch.new(f"s1_{feed}", s1)
    stage2 = ch.new(f"s2_{feed}", f"SELECT *, {_postal('_pt')} AS _postal, {_after_postal('_pt')} AS _rest FROM {stage}")
    tail = f"{address_sql('_rest')} AS normalized_full_address, {r2('_postal')} AS normalized_postal_code"
    if feed == "purchase":
        pp, cp = _phone_split("_phone")
        cm, pm = _mail_split("_mail")
        body = f"""SELECT seq, normalized_company_name, normalized_personal_name,
 {pp} AS normalized_personal_phone_number, {cp} AS normalized_company_phone_number,
 {cm} AS normalized_company_email, {pm} AS normalized_personal_email, {tail}, invoice_company_number FROM {stage2}"""
    elif feed == "sales":
        p1p, p1c = _phone_split("_p1")
        p2p, p2c = _phone_split("_p2")
        cm, pm = _mail_split("_mail")
        body = f"""SELECT seq, normalized_company_name, normalized_personal_name,
 CASE WHEN ({p1p}) <> '' THEN ({p1p}) ELSE ({p2p}) END AS normalized_personal_phone_number,
 CASE WHEN ({p1c}) <> '' THEN ({p1c}) ELSE ({p2c}) END AS normalized_company_phone_number,
 {cm} AS normalized_company_email, {pm} AS normalized_personal_email, {tail} FROM {stage2}"""
    else:
        body = f"""SELECT seq, normalized_company_name, normalized_company_phone_number,
 normalized_company_fax_number, normalized_company_email, {tail}, invoice_company_number FROM {stage2}"""
    return ch.add(name, body)


# ---- views -----------------------------------------------------------------------
COMPANY_VIEW_COLS = [c for c in fixed.M_COMPANY_COLUMNS if c not in ("company_code", "president_person_id")]
PERSON_VIEW_COLS = [c for c in fixed.M_PERSON_COLUMNS if c != "person_id"]
FLAG_OF = {"crm": "customer_flag", "name_card": None, "purchase": "supplier_flag", "sales": "customer_flag",
           "invoice": "payment_flag"}
BIGINT_COLS = {"employees_volume", "annual_revenue"}
BOOL_COLS = set(fixed.COMPANY_FLAGS)
TS_COLS = {"insert_datetime", "update_datetime"}


def _null(c):
    if c in BIGINT_COLS:
        return f"CAST(NULL AS BIGINT) AS {c}"
    if c in BOOL_COLS:
        return f"CAST(NULL AS BOOLEAN) AS {c}"
    if c in TS_COLS:
        return f"CAST(NULL AS TIMESTAMP) AS {c}"
    return f"CAST(NULL AS VARCHAR) AS {c}"


def company_view(ch: Chain, feed: str) -> str:
    name = f"cview_{feed}"
    if any(n == name for n, _ in ch.ctes):
        return name
    s = standardized(ch, feed)
    if feed == "crm":
        pref_name = "s.prefecture"
    else:
        pref_name = pref_extract("s.normalized_full_address")
    vals = {
        "company_name": "s.normalized_company_name",
        "postal_code": "s.postal_code" if feed == "crm" else "s.normalized_postal_code",
        "prefecture_code": "p.prefecture_code",
        "full_address": "s.normalized_full_address",
        "main_phone_number": "s.normalized_company_phone_number",
        "main_email_address": "s.normalized_company_email",
        "insert_datetime": RUN_TS, "update_datetime": RUN_TS,
        "contact_permission": "s.contact_permission" if feed == "crm" else "false",
    }
    if feed == "crm":
        for c in ("employees_volume", "annual_revenue", "url", "industry"):
            vals[c] = f"s.{c}"
    if feed in ("purchase", "invoice"):
        vals["invoice_company_number"] = "s.invoice_company_number"
    if feed == "invoice":
        vals["fax_number"] = "s.normalized_company_fax_number"
    for f in ("customer_flag", "supplier_flag", "payment_flag"):
        vals[f] = "true" if FLAG_OF[feed] == f else "false"
    cols = ", ".join(f"{vals[c]} AS {c}" if c in vals else _null(c) for c in COMPANY_VIEW_COLS)
    return ch.add(name, f"SELECT s.seq, {cols} FROM {s} s LEFT JOIN pref p ON p.prefecture_name = {pref_name}")


# ---- E1: pairwise dedupe with global renumbering -----------------------------------
def dedupe(ch: Chain, src: str, cols: list, combos, tag: str) -> str:
    """Returns a CTE with ``cols`` + ``r`` (final row order, 1..n)."""
    cur = ch.new(f"{tag}_d0", f"SELECT {', '.join(cols)}, row_number() OVER (ORDER BY seq) AS r FROM {src}")
    collist = ", ".join(cols)
    for p, (k1, k2) in enumerate(combos, start=1):
        g = ch.new(f"{tag}_g{p}", f"""SELECT *, CASE WHEN {k1} IS NOT NULL AND {k1} <> '' AND {k2} IS NOT NULL
 AND {k2} <> '' THEN count(*) OVER (PARTITION BY {k1}, {k2}) ELSE 1 END AS n FROM {cur}""")
        others = [c for c in cols if c not in (k1, k2)]
        aggs = ", ".join(f"min_by({c}, r) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in others)
        m = ch.new(f"{tag}_m{p}", f"SELECT {k1}, {k2}, {aggs} FROM {g} WHERE n > 1 GROUP BY {k1}, {k2}")
        cur = ch.new(f"{tag}_d{p}", f"""SELECT {collist}, row_number() OVER (ORDER BY f,
 CASE WHEN f = 0 THEN {k1} ELSE '' END, CASE WHEN f = 0 THEN {k2} ELSE '' END, r0) AS r FROM (
 SELECT {collist}, 0 AS f, 0 AS r0 FROM {m}
 UNION ALL SELECT {collist}, 1 AS f, r AS r0 FROM {g} WHERE n = 1) x""")
    return cur


# ---- E3-E7 -----------------------------------------------------------------------
def match(ch: Chain, batch: str, master: str, combos, pk: str, tag: str) -> str:
    parts = [f"""SELECT n.seq, {i} AS rk, max(m.{pk}) AS pk FROM {batch} n JOIN {master} m
 ON n.{a} = m.{a} AND n.{b} = m.{b} WHERE n.{a} <> '' AND n.{b} <> '' GROUP BY n.seq"""
             for i, (a, b) in enumerate(combos)]
    cand = ch.new(f"{tag}_mc", "\nUNION ALL\n".join(parts))
    return ch.new(f"{tag}_best", f"SELECT seq, max_by(pk, rk) AS {pk} FROM {cand} GROUP BY seq")


def upsert(ch: Chain, view: str, view_cols: list, master: str, kind: str, tag: str, feed: str):
    """Returns dict of CTE names: dd, best, upd, ins, coded_ins, merged, master, attach."""
    if kind == "company":
        combos, pk, layout = fixed.COMPANY_COMBINATIONS, "company_code", list(fixed.M_COMPANY_COLUMNS)
        update_cols = ["company_name", "postal_code", "prefecture_code", "full_address", "main_phone_number",
                       "main_email_address"] + list(EXTRA_UPDATE[feed]) + ["update_datetime"]
        flags = list(fixed.COMPANY_FLAGS)
    else:
        combos, pk, layout = fixed.PERSON_COMBINATIONS, "person_id", list(fixed.M_PERSON_COLUMNS)
        update_cols, flags = list(fixed.PERSON_UPDATE_COLUMNS), []
    out = {}
    dd = dedupe(ch, view, ["seq"] + view_cols, combos, f"{tag}_dd")
    out["dd"] = dd
    best = match(ch, dd, master, combos, pk, tag)
    out["best"] = best
    out["upd"] = ch.new(f"{tag}_upd", f"SELECT d.*, b.{pk} FROM {dd} d JOIN {best} b ON d.seq = b.seq")
    out["ins"] = ch.new(f"{tag}_ins", f"SELECT d.* FROM {dd} d WHERE d.seq NOT IN (SELECT seq FROM {best})")
    start = f"(SELECT coalesce(max(CAST({pk} AS BIGINT)), 0) FROM {master})"
    out["coded"] = ch.new(f"{tag}_coded", f"""SELECT i.*, lpad(CAST({start} + row_number() OVER (ORDER BY r)
 AS VARCHAR), 10, '0') AS {pk} FROM {out['ins']} i""")
    # E7 (+E8): last update row per key in the batch order
    src = ch.new(f"{tag}_src", f"""SELECT * FROM (SELECT u.*, row_number() OVER (PARTITION BY {pk} ORDER BY r DESC)
 AS rn FROM {out['upd']} u) WHERE rn = 1""")
    sets = []
    for c in layout:
        if c == pk:
            sets.append(f"T.{c}")
        elif c in flags:
            sets.append(f"CASE WHEN S.{pk} IS NULL THEN T.{c} ELSE (coalesce(S.{c}, false) OR coalesce(T.{c}, false)) END AS {c}")
        elif c in update_cols and c in view_cols:
            if c in BIGINT_COLS or c in BOOL_COLS or c in TS_COLS:
                sets.append(f"coalesce(S.{c}, T.{c}) AS {c}")
            else:
                sets.append(f"coalesce(nullif(S.{c}, ''), T.{c}) AS {c}")
        else:
            sets.append(f"T.{c}")
    out["merged"] = ch.new(f"{tag}_merged", f"SELECT {', '.join(sets)} FROM {master} T LEFT JOIN {src} S ON T.{pk} = S.{pk}")
    ins_cols = ", ".join(c if (c in view_cols or c == pk) else _null(c) for c in layout)
    out["master"] = ch.new(f"{tag}_master", f"SELECT * FROM {out['merged']} UNION ALL SELECT {ins_cols} FROM {out['coded']}")
    if kind == "company":
        keys = ["company_name", "full_address", "main_phone_number", "main_email_address"]
        kc = ", ".join(keys)
        coded_all = ch.new(f"{tag}_codedall", f"SELECT seq, {pk}, {kc} FROM {out['coded']} UNION ALL SELECT seq, {pk}, {kc} FROM {out['upd']}")
        parts = [f"""SELECT s.seq, {i} AS rk, min(c.{pk}) AS code FROM {view} s JOIN {coded_all} c
 ON s.{a} = c.{a} AND s.{b} = c.{b} WHERE s.{a} <> '' AND s.{b} <> '' GROUP BY s.seq"""
                 for i, (a, b) in enumerate(combos)]
        parts.append(f"SELECT seq, {len(combos)} AS rk, {pk} AS code FROM {coded_all}")
        cand = ch.new(f"{tag}_attc", "\nUNION ALL\n".join(parts))
        out["attach"] = ch.new(f"{tag}_attach", f"""SELECT v.seq, x.code AS company_code FROM {view} v LEFT JOIN
 (SELECT seq, min_by(code, rk) AS code FROM {cand} GROUP BY seq) x ON v.seq = x.seq""")
    return out


EXTRA_UPDATE = {
    "crm": ("employees_volume", "annual_revenue", "url", "industry", "contact_permission", "customer_flag"),
    "name_card": (),
    "purchase": ("invoice_company_number", "supplier_flag"),
    "sales": ("customer_flag",),
    "invoice": ("fax_number", "invoice_company_number", "payment_flag"),
}


def person_view(ch: Chain, feed: str, attach: str, tag: str) -> str:
    s = standardized(ch, feed)
    has = set(NORM_COLS[feed])
    src = {"name": "normalized_personal_name", "name_kana": "normalized_personal_name_kana",
           "department": "normalized_department", "job_post": "normalized_job_post",
           "phone_number": "normalized_personal_phone_number", "email_address": "normalized_personal_email"}
    cols = []
    for c in PERSON_VIEW_COLS:
        if c == "company_code":
            cols.append("a.company_code")
        elif c in TS_COLS:
            cols.append(f"{RUN_TS} AS {c}")
        elif src[c] in has:
            cols.append(f"s.{src[c]} AS {c}")
        else:
            cols.append(_null(c))
    return ch.new(f"{tag}_pview", f"SELECT s.seq, {', '.join(cols)} FROM {s} s LEFT JOIN {attach} a ON s.seq = a.seq")


def president(ch: Chain, m_company: str, m_person: str, tag: str) -> str:
    cond = " OR ".join(f"contains(job_post, {lit(w)})" for w in PRES_KW) or "false"
    pres = ch.new(f"{tag}_pres", f"""SELECT company_code, min(person_id) AS pid FROM {m_person}
 WHERE coalesce(({cond}), false) AND company_code IS NOT NULL GROUP BY company_code""")
    cols = ", ".join("coalesce(nullif(P.pid, ''), T.president_person_id) AS president_person_id"
                     if c == "president_person_id" else f"T.{c}" for c in fixed.M_COMPANY_COLUMNS)
    return ch.new(f"{tag}_linked", f"SELECT {cols} FROM {m_company} T LEFT JOIN {pres} P ON T.company_code = P.company_code")


# ---- seeds -----------------------------------------------------------------------
def seed_company(ch: Chain) -> str:
    if any(n == "seed_company" for n, _ in ch.ctes):
        return "seed_company"
    vals = {
        "company_code": "lpad(CAST(e+1 AS STRING),10,'0')",
        "company_name": "CASE WHEN e%6=2 THEN '休眠商亊'||CAST(e-1 AS STRING) WHEN e%6<>0 THEN '休眠商事'||CAST(e AS STRING) WHEN e%4=0 THEN '取引先'||CAST(e AS STRING) ELSE '株式会社取引先'||CAST(e AS STRING) END",
        "full_address": f"CASE WHEN e%6<>0 THEN '' ELSE {PREF}||'中央区'||CAST(e%9+1 AS STRING)||'-'||CAST(e%20+1 AS STRING)||'-'||CAST(e%30+1 AS STRING) END",
        "main_phone_number": "CASE WHEN e%6<>0 OR e%12=0 THEN '' ELSE '03'||lpad(CAST(e%10000 AS STRING),4,'0')||'1111' END",
        "main_email_address": f"CASE WHEN e%30=0 THEN 'info@e'||{DOM}||'.example' ELSE '' END",
        "employees_volume": "CAST(e%4*100 AS BIGINT)",
        "supplier_flag": "e%8=0",
    }
    cols = ", ".join(f"{vals[c]} AS {c}" if c in vals else _null(c) for c in fixed.M_COMPANY_COLUMNS)
    return ch.add("seed_company", f"SELECT {cols} FROM (SELECT c_custkey AS e FROM customer) b")


def seed_person(ch: Chain) -> str:
    if any(n == "seed_person" for n, _ in ch.ctes):
        return "seed_person"
    vals = {
        "person_id": "lpad(CAST(k+1 AS STRING),10,'0')",
        "name": "CASE WHEN k%2<>0 THEN '休眠太郎' ELSE '山田太郎' END||CAST(k AS STRING)",
        "company_code": "lpad(CAST(k - k%6 + 1 AS STRING),10,'0')",
        "job_post": "CASE WHEN k%18=0 THEN '代表取締役社長' ELSE '課長' END",
        "phone_number": "CASE WHEN k%10=0 THEN '090'||lpad(CAST(k%10000 AS STRING),4,'0')||'0000' ELSE '' END",
        "email_address": "CASE WHEN k%2<>0 THEN '' ELSE 'taro'||CAST(k AS STRING)||'@e'||CAST(k - k%3 AS STRING)||'.example' END",
    }
    cols = ", ".join(f"{vals[c]} AS {c}" if c in vals else _null(c) for c in fixed.M_PERSON_COLUMNS)
    return ch.add("seed_person", f"SELECT {cols} FROM (SELECT c_custkey AS k FROM customer) b")


def instructions(ch: Chain) -> str:
    return ch.add("instr", """SELECT lpad(CAST(e+1 AS STRING),10,'0') AS survivor, lpad(CAST(e+7 AS STRING),10,'0') AS absorbed
FROM (SELECT c_custkey AS e FROM customer WHERE c_custkey%60=0 AND c_custkey>0) b
UNION ALL SELECT '9999999999', '0000000007' UNION ALL SELECT ' 0000000013 ', '8888888888'
UNION ALL SELECT '0000000025' || chr(9), chr(12288) || '0000000031' UNION ALL SELECT chr(12288) || ' 7777777777', '0000000037' || chr(9)""")


# ---- composed steps ----------------------------------------------------------------
def company_step(ch: Chain, feed: str, m_company: str, tag: str):
    v = company_view(ch, feed)
    return upsert(ch, v, COMPANY_VIEW_COLS, m_company, "company", tag, feed)


def person_step(ch: Chain, feed: str, attach: str, m_person: str, tag: str):
    pv = person_view(ch, feed, attach, tag)
    return pv, upsert(ch, pv, PERSON_VIEW_COLS, m_person, "person", tag + "p", feed)


def feed_step(ch: Chain, feed: str, m_company: str, m_person: str, tag: str):
    comp = company_step(ch, feed, m_company, tag)
    if feed not in PERSON_FEEDS:
        return comp["master"], m_person
    _, pers = person_step(ch, feed, comp["attach"], m_person, tag)
    linked = president(ch, comp["master"], pers["master"], tag)
    return linked, pers["master"]


def drop_cols(cte: str, cols) -> str:
    return f"SELECT * EXCLUDE ({', '.join(cols)}) FROM {cte}"


# ---- manual merge -------------------------------------------------------------------
MERGE_COLUMNS = ("company_name", "postal_code", "prefecture_code", "full_address", "employees_volume",
                 "annual_revenue", "main_phone_number", "main_email_address", "url", "industry",
                 "contact_permission", "president_person_id", "customer_flag", "supplier_flag",
                 "payment_flag", "invoice_company_number")


def strip(x: str) -> str:
    """Outer white space of any kind away, line by line of the Unicode list."""
    blanks = "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace())
    return f"regexp_replace({x}, '^[{blanks}]+|[{blanks}]+$', '', 'g')"


def manual_check(ch: Chain, master: str) -> str:
    instructions(ch)
    ch.add("ins", f"SELECT {strip('survivor')} AS s, {strip('absorbed')} AS a FROM instr")
    ch.add("codes", f"SELECT {strip('company_code')} AS code FROM {master} WHERE company_code IS NOT NULL")
    return ch.add("bad", """SELECT DISTINCT * FROM (
 SELECT 'survivor' AS field, s AS code, 'unknown_code' AS problem FROM ins WHERE NOT EXISTS (SELECT 1 FROM codes WHERE code = ins.s)
 UNION ALL SELECT 'absorbed', a, 'unknown_code' FROM ins WHERE NOT EXISTS (SELECT 1 FROM codes WHERE code = ins.a)
 UNION ALL SELECT 'survivor', s, 'self_merge' FROM ins WHERE s = a
 UNION ALL SELECT 'absorbed', a, 'chain' FROM ins WHERE a IN (SELECT s FROM ins WHERE s IS NOT NULL)
 UNION ALL SELECT 'survivor', s, 'repeated_survivor' FROM ins WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1
) x""")


def manual_apply(ch: Chain, master: str) -> str:
    manual_check(ch, master)
    ch.add("valid", """SELECT s, a FROM ins WHERE s IS NOT NULL AND a IS NOT NULL
 AND s NOT IN (SELECT code FROM bad WHERE field = 'survivor' AND code IS NOT NULL)
 AND a NOT IN (SELECT code FROM bad WHERE field = 'absorbed' AND code IS NOT NULL)""")
    fills = []
    for c in MERGE_COLUMNS:
        if c in BIGINT_COLS:
            fills.append(f"coalesce(nullif(S.{c}, 0), A.{c}) AS {c}")
        elif c in BOOL_COLS:
            fills.append(f"coalesce(S.{c}, A.{c}) AS {c}")
        else:
            fills.append(f"coalesce(nullif(S.{c}, ''), A.{c}) AS {c}")
    ch.add("mupd", f"""SELECT v.s AS company_code, {', '.join(fills)} FROM valid v
 JOIN {master} S ON S.company_code = v.s JOIN {master} A ON A.company_code = v.a""")
    sets = []
    for c in fixed.M_COMPANY_COLUMNS:
        if c in MERGE_COLUMNS:
            if c in BIGINT_COLS or c in BOOL_COLS:
                sets.append(f"coalesce(U.{c}, T.{c}) AS {c}")
            else:
                sets.append(f"coalesce(nullif(U.{c}, ''), T.{c}) AS {c}")
        else:
            sets.append(f"T.{c}")
    ch.add("mmerged", f"SELECT {', '.join(sets)} FROM {master} T LEFT JOIN mupd U ON T.company_code = U.company_code")
    return ch.add("mfinal", "SELECT * FROM mmerged m WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.a = m.company_code)")


# ---- reports --------------------------------------------------------------------------
def candidates(ch: Chain, master: str, key_sql: str, reason: str, min_names: int = 1) -> str:
    rows = ch.new("crow", f"""SELECT company_code, company_name, {key_sql} AS candidate_key FROM {master}""")
    rows2 = ch.new("crow", f"SELECT * FROM {rows} WHERE candidate_key IS NOT NULL AND candidate_key <> ''")
    stats = ch.new("cstat", f"""SELECT candidate_key, count(*) AS group_size, min(company_code) AS anchor_code,
 count(DISTINCT company_name) AS name_count FROM {rows2} GROUP BY candidate_key
 HAVING count(*) > 1 AND count(DISTINCT company_name) >= {min_names}""")
    return f"""SELECT {lit(reason)} AS reason, r.candidate_key, s.anchor_code, r.company_code, r.company_name,
 s.group_size, s.name_count FROM {rows2} r JOIN {stats} s ON r.candidate_key = s.candidate_key"""


def near(ch: Chain, master: str) -> str:
    """Names one character apart by brute force: every pair of names of about one length is compared."""
    ch.add("nrow", f"SELECT company_code, company_name, replace(company_name, '株式会社', '') AS k FROM {master}")
    ch.add("nname", r"""SELECT k, min(company_code) AS code, length(k) AS n, regexp_replace(k, '\P{Nd}', '', 'g') AS digits
 FROM nrow WHERE length(k) >= 5 GROUP BY k""")
    ch.add("nlink", """SELECT a.k, b.code FROM nname a JOIN nname b ON a.digits = b.digits AND a.k <> b.k WHERE
 (a.n = b.n AND len(list_filter(range(1, a.n + 1), lambda i: substr(a.k, i, 1) <> substr(b.k, i, 1))) = 1)
 OR (a.n = b.n + 1 AND list_contains(list_transform(range(1, a.n + 1), lambda i: substr(a.k, 1, i - 1) || substr(a.k, i + 1)), b.k))
 OR (b.n = a.n + 1 AND list_contains(list_transform(range(1, b.n + 1), lambda i: substr(b.k, 1, i - 1) || substr(b.k, i + 1)), a.k))""")
    return """SELECT 'near_name' AS reason, r.k AS candidate_key, least(l.least, n.code) AS anchor_code, r.company_code, r.company_name,
 l.size AS group_size, l.size AS name_count FROM nrow r JOIN nname n ON n.k = r.k
 JOIN (SELECT k, count(*) + 1 AS size, min(code) AS least FROM nlink GROUP BY k) l ON l.k = r.k"""


# ---- the registry ---------------------------------------------------------------------
def _q(build) -> str:
    ch = Chain()
    final = build(ch)
    return ch.sql(final)


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    for f in FEEDS:
        q[f"feed_{f}"] = _q(lambda ch, f=f: f"SELECT *, {RUN_TS} AS insert_datetime, {RUN_TS} AS update_datetime FROM {work(ch, f)}")

    def _append(ch):
        nc = errors(ch, "name_card")
        return f"SELECT * FROM {errors(ch, 'crm', f'(SELECT coalesce(max(error_seq), 0) FROM {nc})')}"
    q["error_append_seq"] = _q(_append)

    def _slice(ch):
        ch.add("lake", f"SELECT k AS source_key, {FEED_SELECT['sales']}, day AS update_datetime FROM ({base_sql('sales', ', day')}) b")
        cols = ", ".join(WORK_COLS["sales"])
        return f"""SELECT row_number() OVER (ORDER BY update_datetime, source_key) AS seq, {cols},
 concat_ws('/', phone_number1, phone_number2) AS phones, CAST(length(address) AS INTEGER) AS address_length FROM lake
 WHERE update_datetime >= TIMESTAMP '1997-01-15 00:00:00' AND update_datetime < TIMESTAMP '1997-01-16 00:00:00'"""
    q["daily_slice"] = _q(_slice)

    def _join(ch):
        c, s = clean(ch, "crm"), standardized(ch, "crm")
        return f"""SELECT t1.seq, t2.normalized_company_name, t1.postal_code, t1.prefecture,
 t2.normalized_full_address AS full_address, t1.employees_volume,
 t2.normalized_company_phone_number AS main_phone_number, t2.normalized_company_email AS main_email_address,
 t2.normalized_personal_name, t2.normalized_job_post, upper(t2.normalized_personal_email) AS upper_email,
 CAST(t1.annual_revenue AS DOUBLE) / 1000 AS revenue_thousands FROM {c} t1 INNER JOIN {s} t2 ON t1.seq = t2.seq"""
    q["work_normalized_join"] = _q(_join)
    for f in FEEDS:
        q[f"company_view_{f}"] = _q(lambda ch, f=f: f"SELECT * FROM {company_view(ch, f)}")
    for f in PERSON_FEEDS:
        def _pv(ch, f=f):
            comp = company_step(ch, f, seed_company(ch), "u")
            return f"SELECT * FROM {person_view(ch, f, comp['attach'], 'u')}"
        q[f"person_view_{f}"] = _q(_pv)

    def _pref(ch):
        s = standardized(ch, "sales")
        x = pref_extract("s.normalized_full_address")
        return f"SELECT s.seq, {x} AS prefecture_name, p.prefecture_code FROM {s} s LEFT JOIN pref p ON p.prefecture_name = {x}"
    q["prefecture_lookup"] = _q(_pref)
    for f in FEEDS:
        q[f"errors_{f}"] = _q(lambda ch, f=f: f"SELECT * FROM {errors(ch, f)}")
    for f in FEEDS:
        q[f"clean_{f}"] = _q(lambda ch, f=f: f"SELECT * FROM {clean(ch, f)}")
    for f in FEEDS:
        q[f"standardize_{f}"] = _q(lambda ch, f=f: f"SELECT seq, {', '.join(NORM_COLS[f])} FROM {standardized(ch, f)}")
    for f in FEEDS:
        def _ddc(ch, f=f):
            dd = dedupe(ch, company_view(ch, f), ["seq"] + COMPANY_VIEW_COLS, fixed.COMPANY_COMBINATIONS, "dd")
            return drop_cols(dd, ["r"])
        q[f"dedupe_company_{f}"] = _q(_ddc)

    def _pers(ch, f):
        comp = company_step(ch, f, seed_company(ch), "u")
        return person_step(ch, f, comp["attach"], seed_person(ch), "u")
    for f in PERSON_FEEDS:
        q[f"dedupe_person_{f}"] = _q(lambda ch, f=f: drop_cols(_pers(ch, f)[1]["dd"], ["r"]))

    def _crm(ch):
        return company_step(ch, "crm", seed_company(ch), "u")
    q["match_company"] = _q(lambda ch: drop_cols(_crm(ch)["upd"], ["r"]))
    q["match_person"] = _q(lambda ch: drop_cols(_pers(ch, "crm")[1]["upd"], ["r"]))
    q["insert_rows_company"] = _q(lambda ch: drop_cols(_crm(ch)["ins"], ["r"]))
    q["insert_rows_person"] = _q(lambda ch: drop_cols(_pers(ch, "crm")[1]["ins"], ["r"]))
    q["mint_company_codes"] = _q(lambda ch: f"SELECT seq, company_code FROM {_crm(ch)['coded']}")
    q["attach_company_code"] = _q(lambda ch: f"SELECT * FROM {_crm(ch)['attach']}")
    q["merge_update_company"] = _q(lambda ch: f"SELECT * FROM {_crm(ch)['merged']}")
    for f in FEEDS:
        q[f"upsert_company_{f}"] = _q(lambda ch, f=f: f"SELECT * FROM {company_step(ch, f, seed_company(ch), 'u')['master']}")
    for f in PERSON_FEEDS:
        q[f"upsert_person_{f}"] = _q(lambda ch, f=f: f"SELECT * FROM {_pers(ch, f)[1]['master']}")
    def _fold(ch):
        mc, mp = seed_company(ch), seed_person(ch)
        for i, f in enumerate(FEEDS):
            mc, mp = feed_step(ch, f, mc, mp, f"f{i}")
        return mc, mp
    q["president_link"] = _q(lambda ch: f"SELECT * FROM {_fold(ch)[0]}")
    q["fold_company_master"] = _q(lambda ch: f"SELECT * FROM {_fold(ch)[0]}")
    q["fold_person_master"] = _q(lambda ch: f"SELECT * FROM {_fold(ch)[1]}")
    q["manual_merge_check"] = _q(lambda ch: f"SELECT * FROM {manual_check(ch, seed_company(ch))}")
    q["manual_merge_apply"] = _q(lambda ch: f"SELECT * FROM {manual_apply(ch, seed_company(ch))}")

    def _orph(ch):
        m = manual_apply(ch, seed_company(ch))
        p = seed_person(ch)
        return f"""SELECT * FROM {p} p WHERE p.company_code IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM {m} m WHERE m.company_code = p.company_code)"""
    q["orphan_persons"] = _q(_orph)

    def _errs(ch):
        parts = [f"SELECT *, {lit(f)} AS source FROM {errors(ch, f)}" for f in FEEDS]
        return ch.new("elist", "\nUNION ALL BY NAME\n".join(parts))
    q["error_list"] = _q(lambda ch: f"SELECT * FROM {_errs(ch)}")
    # a row of source number k came in k % 7 days before the run day
    def _trend(ch):
        parts = [f"""SELECT {lit(f)} AS source, error_reason, CAST(CAST({RUN_TS} AS DATE) - CAST(seq % 7 AS INTEGER) AS DATE) AS error_date
 FROM {failing(ch, f)}""" for f in FEEDS]
        rows = ch.new("trow", "\nUNION ALL\n".join(parts))
        return f"SELECT error_date, source, error_reason, count(*) AS error_count FROM {rows} GROUP BY 1, 2, 3"
    q["error_trend"] = _q(_trend)
    def _names(ch):
        master = _fold(ch)[0]
        alike = ch.new("alike", candidates(ch, master, "replace(company_name, '株式会社', '')", "similar_name", 2))
        return f"SELECT * FROM {alike} UNION ALL BY NAME {near(ch, master)}"
    q["candidates_name"] = _q(_names)
    q["candidates_address"] = _q(lambda ch: candidates(ch, _fold(ch)[0], "full_address", "same_address", 2))
    q["candidates_domain"] = _q(lambda ch: candidates(
        ch, _fold(ch)[0], "CASE WHEN contains(main_email_address, '@') THEN split_part(main_email_address, '@', -1) END",
        "same_mail_domain"))
    q["company_list"] = _q(lambda ch: f"SELECT * FROM {_fold(ch)[0]} WHERE prefecture_code = '13'")

    def _plist(ch):
        mc, mp = _fold(ch)
        return f"SELECT p.*, c.company_name FROM {mp} p LEFT JOIN (SELECT company_code, company_name FROM {mc}) c ON p.company_code = c.company_code"
    q["person_list"] = _q(_plist)
    return q
