from prefshare.plans.jobs import main

main()
