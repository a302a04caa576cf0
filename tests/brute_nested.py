"""Plain-Python flattening to test against."""

import json


def listed(v):
    return v if isinstance(v, list) else [] if v is None else [v]


def decoded(text):
    try:
        v = json.loads(text)
        return json.loads(v) if isinstance(v, str) else v
    except (TypeError, ValueError):
        return None


def get(v, *keys):
    for k in keys:
        v = v.get(k) if isinstance(v, dict) else None
    return v


def nvd_rows(item_id, cve, raw):
    raw, own = decoded(raw), decoded(cve)
    v = own if isinstance(own, dict) and own else get(raw, "cve")
    v = decoded(v) if isinstance(v, str) else v
    out = []
    add = lambda child, value, *path: value is not None and out.append(("nvd_items", str(item_id), child, ".".join(map(str, path)), value))
    if not isinstance(v, dict):
        return out
    old = "CVE_data_meta" in v
    for i, d in enumerate(listed(get(v, "description", "description_data") if old else get(v, "descriptions"))):
        add("description", get(d, "lang"), i)
    for i, w in enumerate(listed(get(v, "problemtype", "problemtype_data") if old else get(v, "weaknesses"))):
        for j, d in enumerate(listed(get(w, "description"))):
            add("weakness", get(d, "value"), i, j)
    for i, r in enumerate(listed(get(v, "references", "reference_data") if old else get(v, "references"))):
        add("reference", get(r, "url"), i)
        for j, t in enumerate(listed(get(r, "tags"))):
            add("reference_tag", t, i, j)
    if old:
        for i, n in enumerate(listed(get(raw, "configurations", "nodes"))):
            for j, m in enumerate(listed(get(n, "cpe_match"))):
                add("cpe", get(m, "cpe23Uri"), i, j)
            for j, c in enumerate(listed(get(n, "children"))):
                for k, m in enumerate(listed(get(c, "cpe_match"))):
                    add("cpe", get(m, "cpe23Uri"), i, j, k)
    else:
        for i, c in enumerate(listed(get(v, "configurations"))):
            for j, n in enumerate(listed(get(c, "nodes"))):
                for k, m in enumerate(listed(get(n, "cpeMatch"))):
                    add("cpe", get(m, "criteria"), i, j, k)
    return out


def feature_rows(record_id, text):
    v, out = decoded(text), []
    if not isinstance(v, dict):
        return out
    for i, c in enumerate(listed(v.get("cwe_ids"))):
        out.append(("silver_records", record_id, "cwe", str(i), c))
    for i, a in enumerate(listed(v.get("affected"))):
        if get(a, "package", "name") is not None:
            out.append(("silver_records", record_id, "affected", str(i), get(a, "package", "name")))
        for j, r in enumerate(listed(get(a, "ranges"))):
            for k, e in enumerate(listed(get(r, "events"))):
                out += [("silver_records", record_id, "range_event", f"{i}.{j}.{k}", f"{key}={x}") for key, x in e.items() if x is not None]
    return out
