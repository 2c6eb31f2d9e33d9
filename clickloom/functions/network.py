"""IP addresses as fixed-width hex text, whose order is the numeric order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4]\d|1?\d?\d)"
_V4 = rf"^({_OCTET}\.){{3}}{_OCTET}$"
_HEX = "[0-9a-f]{1,4}"
_V6_FULL = f"({_HEX}:){{7}}{_HEX}"
_V6_SHORT = f"(?!.*::.*::)(?!.*:::)({_HEX}(:{_HEX})*)?::({_HEX}(:{_HEX})*)?"
_V6 = f"^({_V6_FULL}|{_V6_SHORT})$"
#: IPv4 addresses sort inside the IPv4-mapped block of the IPv6 space.
_MAPPED = "0" * 20 + "ffff"


def _groups(text: Column) -> Column:
    return F.filter(F.split(text, ":"), lambda group: group != "")


def address_position(ip: Column) -> Column:
    """32 hex digits for an IPv4 or IPv6 address, NULL for anything else."""
    octets = F.transform(
        F.split(ip, r"\."), lambda o: F.lpad(F.lower(F.hex(o.try_cast("bigint"))), 2, "0")
    )
    low = F.lower(ip)
    zeros = F.repeat(F.lit("0:"), F.lit(8) - F.size(_groups(low)))
    whole = F.replace(low, F.lit("::"), F.concat(F.lit(":"), zeros))
    groups = F.transform(_groups(whole), lambda group: F.lpad(group, 4, "0"))
    return F.when(ip.rlike(_V4), F.concat(F.lit(_MAPPED), F.array_join(octets, ""))).when(
        low.rlike(_V6), F.array_join(groups, "")
    )
