from eventide.sources.parsers import (Parsed, read_lines, parse_user_behavior, parse_access_log,
                                      parse_ad_click, parse_login, parse_order, parse_receipt)
from eventide.sources.fixtures import Fixtures

__all__ = ["Parsed", "read_lines", "parse_user_behavior", "parse_access_log", "parse_ad_click",
           "parse_login", "parse_order", "parse_receipt", "Fixtures"]
