"""The library run over the tables of TESTDATA.md, with reference SQL for each query."""
