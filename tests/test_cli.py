"""The command-line runner lists queries and rejects unknown ones."""

from relayplan.__main__ import main


def test_list_and_unknown(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out.split()
    assert "transfer_summary" in out and "stream_release_waiting" in out
    assert main(["run", "no_such_query", "--data", "/nowhere"]) == 2
