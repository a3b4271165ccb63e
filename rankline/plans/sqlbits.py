"""Small builders for check SQL: rule lists become VALUES and are searched by priority."""


def lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def alias(expr: str, pairs, default: str) -> str:
    values = ", ".join(f"({i}, {lit(a)}, {lit(r)})" for i, (a, r) in enumerate(pairs))
    return f"coalesce((SELECT arg_min(v.r, v.k) FROM (VALUES {values}) v(k, a, r) WHERE contains({expr}, v.a)), {default})"


def has(expr: str, words) -> str:
    """True when one of the words occurs, by a list search."""
    return f"len(list_filter([{', '.join(lit(w) for w in words)}], lambda w: contains({expr}, w))) > 0"


def to_float(s: str) -> str:
    head = f"regexp_extract(regexp_extract(trim({s}), '^[^\\n(（]*'), '[0-9.]+')"
    return f"coalesce(TRY_CAST({head} AS DOUBLE), TRY_CAST(trim({s}) AS DOUBLE))"


def digits(s: str) -> str:
    return f"TRY_CAST(regexp_replace({s}, '[^0-9.\\-]', '', 'g') AS DOUBLE)"


def valid_name(t: str) -> str:
    return (
        f"(length(trim({t})) > 1 AND NOT regexp_full_match(trim({t}), '[0-9]+') AND trim({t}) NOT IN "
        f"('普通类','少数民族预科班','不限','无','历史类','物理类','综合改革') AND regexp_matches({t}, '[一-鿿]'))"
    )


def squeeze(t: str) -> str:
    return f"regexp_replace(replace(replace({t}, '（', '('), '）', ')'), '\\s+', '', 'g')"


def province(t: str) -> str:
    keys = [(k, n) for n, ks in (
        ("江苏", ("江苏", "江苏省", "js", "jiangsu")), ("广东", ("广东", "广东省", "gd", "guangdong")),
        ("福建", ("福建", "福建省", "fj", "fujian")), ("河北", ("河北", "河北省", "hb", "hebei"))) for k in ks]
    m = "MAP {" + ", ".join(f"{lit(k)}: {lit(n)}" for k, n in keys) + "}"
    bare = f"regexp_replace(trim({t}), '(省|市|壮族自治区|回族自治区|维吾尔自治区|自治区)$', '')"
    return f"coalesce({m}[lower(trim({t}))], {m}[lower({bare})], {bare}, '')"
