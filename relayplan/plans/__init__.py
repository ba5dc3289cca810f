"""Named queries. Importing this package registers all of them.

q_planning  URIs, resolution, actions, summaries, reports (E-*, J-1..J-10, A-2, A-3, A-7, W-6, U-4)
q_expand    folder expansion, recursive and copy jobs, loop guard, collisions (J-5, A-1, A-4, A-8, P-14)
q_events    request events: validation, routing, normalisation, item checks (S-1, S-2, P-1..P-7)
q_rename    renaming map resolution and rename plans (J-11..J-15, W-1)
q_jobs      verification, job states, registry, heartbeats (J-16..J-20, W-3, W-4, S-5..S-9, A-5, A-6, T-4, T-5, T-7)
q_stored    stored tables: loaders, plan writer (S-3, S-4, S-10, E-6, E-13, E-16)
q_stream    streams checked against their batch twins, quarantine (T-1..T-10, S-11, S-12)

Each query's DuckDB twin is registered with it (``registry.query``);
``oracle_base`` holds the input tables as SQL and ``planner`` the
event-to-plan path.
"""

from relayplan.plans import q_events, q_expand, q_jobs, q_planning, q_rename, q_stored, q_stream  # noqa: F401
from relayplan.plans.registry import ORACLES, QUERIES  # noqa: F401
