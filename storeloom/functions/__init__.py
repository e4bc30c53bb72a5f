from storeloom.functions.conform import conform, require_key
from storeloom.functions.retail import day_of, full_name, net_of, percent_of, product_of

__all__ = ["conform", "day_of", "full_name", "net_of", "percent_of", "product_of", "require_key"]
