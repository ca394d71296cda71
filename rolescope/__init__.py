"""rolescope: profile, report on and classify wide event tables with Spark.

A table is described once by its column *roles* (``rolescope.roles.Roles``); every
operator takes a DataFrame plus those roles and returns a lazy DataFrame.
"""

from rolescope.roles import Roles

__all__ = ["Roles"]
