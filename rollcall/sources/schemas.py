"""Schemas of inbound documents and stored tables, vocabularies, and what each document must hold."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

from rollcall.functions import validate as V

_LINKS = "array<struct<note:string,date:string,classification:string,links:array<struct<url:string,media_type:string>>>>"
_SOURCES = "array<struct<url:string,note:string>>"

DOCUMENTS: dict[str, str] = {
    "bill": f"_id string, legislative_session string, identifier string, title string, from_organization string, classification array<string>, subject array<string>, "
            "abstracts array<struct<abstract:string,note:string>>, other_titles array<struct<title:string,note:string>>, other_identifiers array<struct<identifier:string>>, "
            "actions array<struct<description:string,date:string,organization_id:string,classification:array<string>>>, "
            "sponsorships array<struct<name:string,classification:string,entity_type:string,primary:boolean,person_id:string,organization_id:string>>, "
            f"related_bills array<struct<identifier:string,legislative_session:string,relation_type:string>>, versions {_LINKS}, documents {_LINKS}, sources {_SOURCES}, extras string",
    "vote_event": f"_id string, identifier string, motion_text string, motion_classification array<string>, start_date string, result string, organization string, legislative_session string, bill string, "
                  f"bill_action string, bill_identifier string, votes array<struct<option:string,voter_name:string,voter_id:string,note:string>>, counts array<struct<option:string,value:int>>, sources {_SOURCES}, extras string",
    "event": f"_id string, name string, description string, classification string, start_date string, end_date string, all_day boolean, status string, upstream_id string, location struct<name:string,note:string,url:string>, "
             f"participants array<struct<name:string,type:string,note:string>>, agenda array<struct<description:string,order:string,subjects:array<string>>>, sources {_SOURCES}, extras string",
    "person": "id string, name string, given_name string, family_name string, middle_name string, suffix string, gender string, email string, birth_date string, death_date string, "
              "party array<struct<name:string,start_date:string,end_date:string>>, roles array<struct<type:string,jurisdiction:string,district:string,start_date:string,end_date:string,end_reason:string>>, "
              f"offices array<struct<classification:string,name:string,address:string,voice:string,fax:string>>, other_names array<struct<name:string,start_date:string,end_date:string>>, links {_SOURCES}, sources {_SOURCES}",
    "organization": f"_id string, name string, classification string, parent_id string, other_names array<struct<name:string>>, sources {_SOURCES}",
}

# fixed values: vocabularies
CHAMBERS = ("upper", "lower", "legislature")
VOTE_OPTIONS = ("yes", "no", "absent", "abstain", "not voting", "paired", "excused", "other")
VOTE_RESULTS = ("pass", "fail")
EVENT_STATUS = ("cancelled", "tentative", "confirmed", "passed")
BILL_RELATIONS = ("companion", "prior-session", "replaced-by", "replaces", "related")
# fixed values end

#: kind of child table -> what happens to it when its parent goes
DELETE_RULES = {"bill_action": "cascade", "bill_sponsorship": "cascade", "bill_version": "cascade", "vote_event": "cascade", "person_vote": "cascade", "membership.person": "set_null", "membership.organization": "cascade",
                "event_location": "set_null", "division.redirect": "set_null", "bill.session": "protect", "organization.jurisdiction": "protect", "session.jurisdiction": "protect"}


def schema(kind: str) -> StructType:
    return StructType.fromDDL(DOCUMENTS[kind])


def _filled(c: str) -> Column:
    return V.rule(F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) > 0, f"{c} is required")


def _some(c: str) -> Column:
    return V.rule(F.coalesce(F.size(c), F.lit(0)) > 0, f"{c} needs an item")


def document_problems(kind: str) -> Column:
    """What is wrong with a document of a kind, as an array of messages."""
    c = F.col
    if kind == "bill":
        found = [_filled("legislative_session"), _filled("identifier"), _filled("title"), _some("sources"),
                 V.rule(~F.exists("actions", lambda a: ~V.is_fuzzy_datetime(a["date"])), "invalid action date"),
                 V.rule(~F.exists("related_bills", lambda r: ~r["relation_type"].isin(*BILL_RELATIONS)), "unknown relation"),
                 V.rule(~F.exists("sponsorships", lambda s: F.coalesce(s["name"], F.lit("")) == ""), "sponsor without name")]
    elif kind == "vote_event":
        found = [_filled("motion_text"), _some("sources"), V.rule(c("result").isin(*VOTE_RESULTS), "unknown result"), V.rule(V.is_fuzzy_datetime(c("start_date")), "invalid start_date"),
                 V.rule(~F.exists("votes", lambda v: ~v["option"].isin(*VOTE_OPTIONS)), "unknown option"), V.rule(~F.exists("counts", lambda v: v["value"] < 0), "negative count")]
    elif kind == "event":
        found = [_filled("name"), _filled("start_date"), _some("sources"), V.rule(c("status").isin(*EVENT_STATUS), "unknown status")]
    elif kind == "person":
        found = [_filled("name"), V.rule(V.is_fuzzy_date(F.coalesce("birth_date", F.lit(""))), "invalid birth_date"), V.rule(~F.exists("roles", lambda r: ~V.is_fuzzy_date(F.coalesce(r["end_date"], F.lit("")))), "invalid role date")]
    else:
        found = [_filled("name"), _filled("classification")]
    return V.problems(*found)
